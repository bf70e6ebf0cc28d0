"""Raw payloads to canonical snapshot rows.

Each normalizer takes rows with a key, ``source_id``, and a JSON or XML text in ``payload``, and gives one row per item. An absent
value is null, never guessed; items without the required texts are left out.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodiff.functions.identity import collapse, slug
from chronodiff.operators.diff import last_of

# Cost fields of the token price map.
COST_FIELDS = [
    ("input_cost_per_token", "input", "standard"),
    ("output_cost_per_token", "output", "standard"),
    ("cache_read_input_token_cost", "input", "cached_read"),
    ("cache_creation_input_token_cost", "input", "cached_write"),
    ("input_cost_per_token_batches", "input", "batch"),
    ("output_cost_per_token_batches", "output", "batch"),
    ("input_cost_per_token_priority", "input", "priority"),
    ("output_cost_per_token_priority", "output", "priority"),
]
# Inference types of the cloud price list.
INFERENCE_TYPES = [
    ("input tokens", "input", "standard"),
    ("output tokens", "output", "standard"),
    ("text input tokens", "input", "standard"),
    ("text output tokens", "output", "standard"),
    ("input tokens batch", "input", "batch"),
    ("output tokens batch", "output", "batch"),
    ("input tokens priority", "input", "priority"),
    ("output tokens priority", "output", "priority"),
    ("prompt cache read input tokens", "input", "cached_read"),
    ("prompt cache write input tokens", "input", "cached_write"),
]
# Words of meter names.
METER_DIRECTIONS = {"inp": "input", "in": "input", "inpt": "input", "input": "input", "outp": "output", "out": "output", "outpt": "output", "output": "output"}
METER_TIERS = {"batch": "batch", "cached": "cached_read", "cchd": "cached_read", "cachd": "cached_read", "cd": "cached_read", "pp": "priority"}
METER_SCOPES = {"gl": "global", "glbl": "global", "global": "global", "dz": "datazone", "dzn": "datazone", "datazone": "datazone", "regnl": "regional", "rgnl": "regional", "regional": "regional"}
METER_UNITS = ["1k", "1m", "tokens", "token"]
# Words of lifecycle in order, and of relevance.
LIFECYCLE = [("resolved", "resolved"), ("mitigated", "resolved"), ("restored", "resolved"), ("investigating", "investigating"), ("monitoring", "monitoring"), ("degradation", "identified"), ("degraded", "identified")]
RELEVANT = ["openai", "ai foundry", "foundry models", "cognitive services"]
# Wrapper tags of flat payload graphs.
WRAPPERS = {"ShallowReactive", "Reactive", "ShallowRef", "Ref", "EmptyShallowRef", "EmptyRef"}

PRICES = ["source_id", "model_ref", "direction", "tier", "region", "value"]
INCIDENTS = ["source_id", "id", "status", "components", "updated_at", "name", "impact", "shortlink"]


def whole_or_null(x: Column) -> Column:
    """A JSON number text that is a whole number, else null (booleans and strings too)."""
    d = x.try_cast("double")
    return F.when(x.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$") & (d == F.floor(d)), d.cast("bigint"))


def words_of(*arrays: Column) -> Column:
    """Sorted distinct union of arrays that may be null."""
    out = F.array().cast("array<string>")
    for a in arrays:
        out = F.array_union(out, F.coalesce(a, F.array().cast("array<string>")))
    return F.array_sort(F.filter(out, lambda x: x.isNotNull()))


def models(df: DataFrame) -> DataFrame:
    """(source_id, id, created, owned_by, endpoints, context_window, modalities) of `{data: [{id, created, context_length, architecture}]}`."""
    item = "id string, created string, context_length string, architecture struct<input_modalities array<string>, output_modalities array<string>>"
    d = df.select("source_id", F.explode(F.from_json("payload", f"data array<struct<{item}>>").data).alias("i")).where(F.col("i.id").isNotNull())
    return d.select("source_id", F.col("i.id").alias("id"), whole_or_null(F.col("i.created")).alias("created"), F.lit(None).cast("string").alias("owned_by"), F.array().cast("array<string>").alias("endpoints"),
                    whole_or_null(F.col("i.context_length")).alias("context_window"), words_of(F.col("i.architecture.input_modalities"), F.col("i.architecture.output_modalities")).alias("modalities"))


def token_price_map(df: DataFrame) -> DataFrame:
    """PRICES of an object of models by name: its cost fields as rows, per million tokens. The member `sample_spec` is documentation."""
    m = df.select("source_id", F.explode(F.from_json("payload", "map<string,map<string,string>>")).alias("model_ref", "f")).where(F.col("model_ref") != "sample_spec")
    rows = F.array(*[F.struct(F.lit(d).alias("direction"), F.lit(t).alias("tier"), F.element_at("f", F.lit(k)).alias("v")) for k, d, t in COST_FIELDS])
    d = m.select("source_id", "model_ref", F.inline(rows)).where(F.col("v").rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"))
    return d.select("source_id", "model_ref", "direction", "tier", F.lit("global").alias("region"), F.round(F.col("v").cast("double") * 1e6, 10).alias("value"))


def incidents(df: DataFrame) -> DataFrame:
    """INCIDENTS of `{incidents: [...]}`; id, status and updated_at are required."""
    item = "id string, status string, updated_at string, impact string, name string, shortlink string, components array<struct<name string>>"
    d = df.select("source_id", F.explode(F.from_json("payload", f"incidents array<struct<{item}>>").incidents).alias("i"))
    d = d.where(F.col("i.id").isNotNull() & F.col("i.status").isNotNull() & F.col("i.updated_at").isNotNull())
    return d.select("source_id", "i.id", "i.status", words_of(F.transform("i.components", lambda c: c["name"])).alias("components"), "i.updated_at", "i.name", "i.impact", "i.shortlink")


def incident_feed(df: DataFrame) -> DataFrame:
    """INCIDENTS of an Atom feed: the number behind `Incident/` of the entry's id, else the id; the first strong word of the content as status."""
    schema = "entry array<struct<id string, updated string, title string, content struct<_VALUE string, _type string>, link array<struct<_rel string, _href string>>>>"
    d = df.select("source_id", F.explode(F.from_xml("payload", schema).entry).alias("e"))
    raw = F.trim("e.id")
    ident = F.coalesce(F.nullif(F.regexp_extract(raw, r"Incident/([A-Za-z0-9]+)", 1), F.lit("")), F.nullif(raw, F.lit("")))
    status = F.nullif(F.lower(F.trim(F.regexp_extract(F.col("e.content._VALUE"), r"(?is)<strong>\s*(.*?)\s*</strong>", 1))), F.lit(""))
    link = F.get(F.filter("e.link", lambda x: (x._rel == "alternate") & x._href.isNotNull()), F.lit(0))["_href"]
    d = d.select("source_id", ident.alias("id"), status.alias("status"), F.array().cast("array<string>").alias("components"), F.nullif(F.trim("e.updated"), F.lit("")).alias("updated_at"),
                 F.nullif(F.trim("e.title"), F.lit("")).alias("name"), F.lit(None).cast("string").alias("impact"), link.alias("shortlink"))
    return d.where(F.col("id").isNotNull() & F.col("status").isNotNull() & F.col("updated_at").isNotNull())


def rfc822_utc(text: Column) -> Column:
    """A mail date as UTC text; `Z` counts as +0000, a missing zone as UTC."""
    t = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},?\s+", ""), r"\s+(?:Z|GMT|UTC|UT)$", " +0000")
    t = F.when(t.rlike(r"[+-]\d{4}$"), t).otherwise(F.concat(t, F.lit(" +0000")))
    return F.date_format(F.coalesce(F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm Z"))), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def lifecycle(text: Column, default: str = "active") -> Column:
    """State named first in the list of words that the lower-case text contains."""
    c = F.when(text.contains(LIFECYCLE[0][0]), LIFECYCLE[0][1])
    for word, state in LIFECYCLE[1:]:
        c = c.when(text.contains(word), state)
    return c.otherwise(default)


def news_feed(df: DataFrame) -> DataFrame:
    """INCIDENTS of an RSS channel: the relevant items; guid else link as id, the state from words of title and description."""
    schema = "channel struct<link string, item array<struct<title string, description string, pubDate string, guid string, link string>>>"
    d = df.select("source_id", F.explode(F.from_xml("payload", schema).channel["item"]).alias("i"))
    title, about = collapse(F.coalesce("i.title", F.lit(""))), collapse(F.coalesce("i.description", F.lit("")))
    text = F.lower(F.concat_ws(" ", title, about))
    ident = F.coalesce(F.nullif(F.trim("i.guid"), F.lit("")), F.nullif(F.trim("i.link"), F.lit("")))
    d = d.select("source_id", ident.alias("id"), lifecycle(text).alias("status"), F.array().cast("array<string>").alias("components"), rfc822_utc(F.col("i.pubDate")).alias("updated_at"),
                 F.nullif(title, F.lit("")).alias("name"), F.lit(None).cast("string").alias("impact"), F.nullif(F.trim("i.link"), F.lit("")).alias("shortlink"), text.rlike("|".join(RELEVANT)).alias("_r"))
    return d.where(F.col("_r") & F.col("id").isNotNull() & F.col("updated_at").isNotNull()).drop("_r")


def service_events(df: DataFrame, word: str) -> DataFrame:
    """INCIDENTS of an array of service events whose service names contain ``word``; status 0 is resolved, 1 open, another kept as status-N."""
    d = df.select("source_id", F.explode(F.from_json("payload", "array<struct<arn string, service string, service_name string, status string, date string, summary string>>")).alias("e"))
    service = F.lower(F.concat_ws(" ", "e.service", "e.service_name"))
    at = F.date_format(F.timestamp_seconds(F.col("e.date").try_cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    s = F.lower(F.trim(F.coalesce("e.status", F.lit(""))))
    name = F.nullif(F.trim(F.regexp_replace("e.summary", r"^\s*\[RESOLVED\]\s*", "")), F.lit(""))
    d = d.where(service.contains(word)).select("source_id", F.nullif(F.col("e.arn"), F.lit("")).alias("id"), F.when(s == "0", "resolved").when(s == "1", "open").otherwise(F.concat(F.lit("status-"), s)).alias("status"),
                                               F.array_compact(F.array(F.nullif(F.col("e.service_name"), F.lit("")))).alias("components"), at.alias("updated_at"), name.alias("name"), F.lit(None).cast("string").alias("impact"), F.lit(None).cast("string").alias("shortlink"))
    return d.where(F.col("id").isNotNull() & F.col("updated_at").isNotNull())


def _is_index(x) -> bool:
    return isinstance(x, int) and not isinstance(x, bool)


def unflattened(flat: list):
    """The value of a flat array whose first slot is the root.

    A slot is a scalar, an object or a list whose members are slot numbers, or a wrapper `[name, slot]` that stands for
    another slot. Every slot is built once and linked where it is used. A number outside the array, a chain of wrappers
    that comes back to itself, and a link from a value to one that contains it are null; members that are no numbers are
    left out.
    """
    alias = {i: v[1] for i, v in enumerate(flat) if isinstance(v, list) and len(v) == 2 and isinstance(v[0], str) and v[0] in WRAPPERS and _is_index(v[1])}

    def slot(i: int) -> int | None:
        for _ in range(len(alias) + 1):
            if i not in alias:
                return i if 0 <= i < len(flat) else None
            i = alias[i]
        return None

    def links(i: int) -> list[tuple]:
        v = flat[i]
        pairs = v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ()
        return [(k, slot(x)) for k, x in pairs if _is_index(x)]

    built = [{} if isinstance(v, dict) else [] if isinstance(v, list) else v for v in flat]

    def put(into, k, value) -> None:
        if isinstance(into, dict):
            into[k] = value
        else:
            into.append(value)

    root = slot(0)
    if root is None:
        return None
    # Depth first; the open slots are those on the way from the root.
    opened, done, way = {root}, set(), [(root, iter(links(root)))]
    while way:
        at, rest = way[-1]
        for k, to in rest:
            put(built[at], k, None if to is None or to in opened else built[to])
            if to is not None and to not in opened and to not in done:
                opened.add(to)
                way.append((to, iter(links(to))))
                break
        else:
            way.pop()
            opened.discard(at)
            done.add(at)
    return built[root]


@F.pandas_udf(T.StringType())
def graph_json(s: pd.Series) -> pd.Series:
    def one(t):
        try:
            flat = json.loads(t)
            return json.dumps(unflattened(flat)) if isinstance(flat, list) and flat else None
        except (TypeError, ValueError, RecursionError):  # no JSON, or nested deeper than can be written
            return None

    return s.map(one)


def graph_incidents(df: DataFrame) -> DataFrame:
    """INCIDENTS of a flat payload graph: the members of `data` named unresolved-incidents-..."""
    item = "id string, status string, name string, updatedAt string, updated_at string, createdAt string, created_at string, services array<struct<name string>>, impactedServices array<struct<name string>>"
    d = df.select("source_id", F.from_json(graph_json(F.col("payload")), f"data map<string,struct<incidents array<struct<{item}>>>>").data.alias("m"))
    d = d.select("source_id", F.explode("m").alias("k", "v")).where(F.col("k").startswith("unresolved-incidents-")).select("source_id", F.explode("v.incidents").alias("i"))
    at = F.coalesce(*[F.nullif(F.col(f"i.{c}"), F.lit("")) for c in ("updatedAt", "updated_at", "createdAt", "created_at")])
    parts = F.when(F.size("i.services") > 0, F.col("i.services")).otherwise(F.col("i.impactedServices"))
    d = d.select("source_id", "i.id", F.lower(F.trim("i.status")).alias("status"), words_of(F.transform(parts, lambda c: c["name"])).alias("components"), at.alias("updated_at"), "i.name", F.lit(None).cast("string").alias("impact"), F.lit(None).cast("string").alias("shortlink"))
    return d.where(F.col("id").isNotNull() & F.col("status").isNotNull() & F.col("updated_at").isNotNull())


def top_price(rows: DataFrame, *order: Column) -> DataFrame:
    """One price per model, direction, tier and region: the greatest in ``order``."""
    return last_of(rows.withColumn("_o", F.struct(*order)), PRICES[:-1], "_o").select(PRICES)


def reversed_text(text: Column) -> Column:
    """A hex text whose order is the reverse of the text's: smallest first when the greatest is taken."""
    return F.translate(F.concat(F.hex(text), F.lit("G")), "0123456789ABCDEFG", "GFEDCBA9876543210")


def price_list(df: DataFrame) -> DataFrame:
    """PRICES of a cloud price list `{products, terms: {OnDemand}}`: products joined to their first token-priced term; the latest, then smallest sku."""
    p = df.select("source_id", F.from_json("payload", "products map<string,struct<attributes map<string,string>>>, terms struct<OnDemand map<string,map<string,struct<effectiveDate string, priceDimensions map<string,struct<unit string, pricePerUnit map<string,string>>>>>>>").alias("d"))
    products = p.select("source_id", F.explode("d.products").alias("sku", "p")).select("source_id", "sku", F.col("p.attributes").alias("a"))
    a = lambda k: F.nullif(F.trim(F.element_at("a", F.lit(k))), F.lit(""))
    kinds = F.create_map(*[x for k, d, t in INFERENCE_TYPES for x in (F.lit(k), F.struct(F.lit(d).alias("direction"), F.lit(t).alias("tier")))])
    products = products.select("source_id", "sku", F.element_at(kinds, F.lower(collapse(a("inferenceType")))).alias("k"), F.coalesce(a("model"), a("titanModel")).alias("model"),
                               F.coalesce(slug(a("provider"), None, "unknown"), F.lit("amazon")).alias("_p"), a("provider").alias("provider"), F.coalesce(a("regionCode"), F.lit("global")).alias("region"))
    ref = F.concat(F.when(F.col("provider").isNull(), "amazon").otherwise(F.col("_p")), F.lit("/"), slug(F.col("model"), None, "unknown"))
    products = products.where(F.col("k").isNotNull() & F.col("model").isNotNull()).select("source_id", "sku", ref.alias("model_ref"), "k.direction", "k.tier", "region")
    t = p.select("source_id", F.explode("d.terms.OnDemand").alias("sku", "t")).select("source_id", "sku", F.explode("t").alias("term", "x")).select("source_id", "sku", "term", F.col("x.effectiveDate").alias("at"), F.explode("x.priceDimensions").alias("dim", "y"))
    unit = F.lower("y.unit")
    usd = F.element_at("y.pricePerUnit", F.lit("USD")).try_cast("double")
    t = t.select("source_id", "sku", "term", "dim", F.coalesce("at", F.lit("")).alias("at"), (usd * F.when(unit == "1k tokens", 1000.0).when(unit == "1m tokens", 1.0)).alias("value")).where(F.col("value").isNotNull())
    t = t.groupBy("source_id", "sku").agg(F.min_by(F.struct("at", "value"), F.struct("term", "dim")).alias("_t")).select("source_id", "sku", "_t.at", F.round("_t.value", 10).alias("value"))
    return top_price(products.join(t, ["source_id", "sku"]), F.col("at"), reversed_text(F.col("sku")))


def pruned_price_list(df: DataFrame) -> DataFrame:
    """(source_id, payload): price lists with only what :func:`price_list` reads, as compact JSON in binary order of names; the evidence that is stored.

    Products stay that have a known inference type, with their terms on demand; null and unreadable payloads stay null.
    """
    d = df.select("source_id", F.from_json("payload", "products map<string,string>, terms struct<OnDemand map<string,string>>, offerCode string, version string").alias("d"))
    kinds = [k for k, _, _ in INFERENCE_TYPES]
    used = F.map_filter("d.products", lambda k, v: F.coalesce(F.lower(collapse(F.get_json_object(v, "$.attributes.inferenceType"))).isin(kinds), F.lit(False)))
    d = d.withColumn("_p", used).withColumn("_t", F.map_filter("d.terms.OnDemand", lambda k, v: F.map_contains_key("_p", k)))
    member = lambda name, m: F.concat(F.lit(f'"{name}":{{'), F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(F.to_json(F.array(e.key)).substr(F.lit(2), F.length(F.to_json(F.array(e.key))) - 2), F.lit(":"), F.to_json(F.try_parse_json(e.value)))), ","), F.lit("}"))
    head = F.concat_ws(",", *[F.concat(F.lit(f'"{c}":'), F.to_json(F.array(F.col(f"d.{c}"))).substr(F.lit(2), F.length(F.to_json(F.array(F.col(f"d.{c}")))) - 2)) for c in ("offerCode", "version")])
    empty = F.create_map().cast("map<string,string>")
    text = F.concat(F.lit("{"), head, F.lit(","), member("products", F.coalesce("_p", empty)), F.lit(',"terms":{'), member("OnDemand", F.coalesce("_t", empty)), F.lit("}}"))
    return d.select("source_id", F.when(F.col("d").isNotNull() & (F.col("_p").isNotNull() | F.col("_t").isNotNull()), text).alias("payload"))


#: What is stored of a body instead of the whole, by the name of the rule that is kept with it.
TRUNCATIONS = {"consumed-products": pruned_price_list}


def truncated(df: DataFrame, rule: str | None) -> DataFrame:
    """(source_id, payload, truncation_rule): bodies as they are stored; a rule that isn't known raises."""
    if rule is None:
        return df.select("source_id", "payload", F.lit(None).cast("string").alias("truncation_rule"))
    return TRUNCATIONS[rule](df).withColumn("truncation_rule", F.lit(rule))


def meter_fields(name: Column) -> Column:
    """Struct (direction, tier, scope, model_ref) of a meter name; null without exactly one direction, with two tiers, or without a model.

    Words between blanks and hyphens are looked up in the lists of directions, tiers, scopes and units; those left make
    the model.
    """
    words = F.filter(F.split(F.lower(name), r"[\s\-]+"), lambda x: x != "")
    table = lambda m: F.create_map(*[F.lit(v) for kv in m.items() for v in kv])
    found = lambda m: F.array_distinct(F.filter(F.transform(words, lambda w: F.element_at(table(m), w)), lambda x: x.isNotNull()))
    d, t, s = found(METER_DIRECTIONS), found(METER_TIERS), F.array_sort(found(METER_SCOPES))
    known = [*METER_DIRECTIONS, *METER_TIERS, *METER_SCOPES, *METER_UNITS]
    base = F.filter(words, lambda w: ~w.isin(known))
    scope = F.get(s, F.lit(0))
    ok = (F.size(d) == 1) & (F.size(t) <= 1) & (F.size(base) > 0) & F.arrays_overlap(words, F.array(F.lit("tokens"), F.lit("token")))
    ref = F.concat_ws("-", F.array_join(base, "-"), scope)
    return F.when(ok, F.struct(d[0].alias("direction"), F.coalesce(F.get(t, F.lit(0)), F.lit("standard")).alias("tier"), scope.alias("scope"), ref.alias("model_ref")))


def meter_rows(items: DataFrame) -> DataFrame:
    """PRICES of retail price rows in columns (source_id, currency_code, price_type, unit_of_measure, meter_name, meter_id, retail_price, arm_region_name, effective_start_date, is_primary_meter_region).

    Of rows with one key the primary meter region counts, then the latest start (as text), then the smallest meter.
    """
    scale = F.when(F.col("unit_of_measure") == "1K", 1000.0).when(F.col("unit_of_measure") == "1M", 1.0)
    d = items.where((F.col("price_type") == "Consumption") & (F.col("currency_code") == "USD") & F.col("unit_of_measure").isin("1K", "1M") & F.col("retail_price").isNotNull())
    d = d.withColumn("_m", meter_fields(F.col("meter_name"))).withColumn("_v", F.round(F.col("retail_price") * scale, 10))
    d = d.select("source_id", F.inline(F.array_compact(F.array("_m"))), F.coalesce(F.nullif("arm_region_name", F.lit("")), F.lit("global")).alias("region"), F.col("_v").alias("value"),
                 F.coalesce(F.col("is_primary_meter_region").cast("int"), F.lit(0)).alias("_a"), F.coalesce("effective_start_date", F.lit("")).alias("_b"), reversed_text(F.coalesce("meter_id", F.lit(""))).alias("_c"))
    return top_price(d, F.col("_a"), F.col("_b"), F.col("_c"), F.col("value"))


def retail_prices(df: DataFrame) -> DataFrame:
    """PRICES of merged pages `{Items: [...]}`."""
    item = "currencyCode string, type string, unitOfMeasure string, meterName string, meterId string, retailPrice double, armRegionName string, effectiveStartDate string, isPrimaryMeterRegion boolean"
    d = df.select("source_id", F.explode(F.from_json("payload", f"Items array<struct<{item}>>").Items).alias("i"))
    return meter_rows(d.select("source_id", F.col("i.currencyCode").alias("currency_code"), F.col("i.type").alias("price_type"), F.col("i.unitOfMeasure").alias("unit_of_measure"), F.col("i.meterName").alias("meter_name"), F.col("i.meterId").alias("meter_id"),
                               F.col("i.retailPrice").alias("retail_price"), F.col("i.armRegionName").alias("arm_region_name"), F.col("i.effectiveStartDate").alias("effective_start_date"), F.col("i.isPrimaryMeterRegion").alias("is_primary_meter_region")))


NORMALIZERS = {"models": models, "token-prices": token_price_map, "status-json": incidents, "status-atom": incident_feed, "status-rss": news_feed, "service-events": service_events, "status-graph": graph_incidents, "price-list": price_list, "retail-prices": retail_prices}
