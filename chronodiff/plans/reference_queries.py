"""The operators of snapshots, events, chains and integrity as queries on the given tables.

Where a table has no two snapshots, both are made of it by rules on its keys, the same in the SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronodiff.functions import identity as I
from chronodiff.functions import urls as U
from chronodiff.operators import corroborate, diff, events, fold, guards, integrity, references, watch
from chronodiff.session import prepare, settled, shared_folder
from chronodiff.sources import normalize, pages, registry, store
from chronodiff.streaming import ingest
from chronodiff.streaming.corroborate import dispatch_stream


def _read(spark: SparkSession, d: str, t: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{d}/{t}.parquet")


def _part_models(spark, d):
    p = _read(spark, d, "part").select(F.lit("part").alias("source_id"), F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("k"), F.col("p_partkey").alias("created"), F.col("p_brand").alias("owned_by"), F.array("p_type").alias("endpoints"), F.col("p_size").cast("bigint").alias("context_window"))
    k = F.col("k")
    prev = p.where(k % 10 != 0)
    cur = p.where(k % 10 != 1).withColumn("context_window", F.col("context_window") + F.when(k % 7 == 0, 1).otherwise(0)).withColumn("owned_by", F.when(k % 11 == 0, "other").otherwise(F.col("owned_by"))).withColumn("endpoints", F.when(k % 13 == 0, F.array(F.lit("new"))).otherwise(F.col("endpoints")))
    return prev.drop("k"), cur.drop("k")


def diff_models(spark, d):
    return diff.diff_models(*_part_models(spark, d)).drop("source_id")


def _part_prices(spark, d):
    k = F.col("p_partkey")
    p = _read(spark, d, "part").select(F.lit("part").alias("source_id"), F.col("p_brand").alias("model_ref"), F.when(k % 2 == 0, "input").otherwise("output").alias("direction"), F.when(k % 3 == 0, "batch").otherwise("standard").alias("tier"), F.lpad(k.cast("string"), 12, "0").alias("region"), F.round("p_retailprice", 2).alias("value"), k.alias("k"))
    prev = p.where(F.col("k") % 10 != 0)
    cur = p.where(F.col("k") % 10 != 1).withColumn("value", F.when(F.col("k") % 7 == 0, F.round(F.col("value") * 2, 2)).otherwise(F.col("value")))
    return diff.price_rows(prev.drop("k"), cur.drop("k"))


def diff_prices(spark, d):
    c = diff.changed_prices(_part_prices(spark, d))
    regions = F.size(F.array_distinct(F.transform("entries", lambda e: e.region)))
    return c.select("model_ref", "direction", F.size("entries").cast("bigint").alias("n"), regions.cast("bigint").alias("regions"), F.round("old", 2).alias("old"), F.round("new", 2).alias("new"), events.percent_change(F.col("old"), F.col("new")).alias("pct"))


def diff_row_counts(spark, d):
    return diff.price_row_counts(_part_prices(spark, d)).drop("source_id")


def diff_status(spark, d):
    k = F.col("o_orderkey")
    o = _read(spark, d, "orders").select(F.lit("orders").alias("source_id"), k.cast("string").alias("id"), F.when(F.col("o_orderstatus") == "F", "resolved").when(F.col("o_orderstatus") == "O", "investigating").otherwise("monitoring").alias("status"), F.array("o_orderpriority").alias("components"), k.alias("k"))
    cur = o.where(F.col("k") % 5 != 1)
    cur = cur.withColumn("status", F.when(F.col("k") % 4 == 0, "resolved").otherwise(F.col("status"))).withColumn("components", F.when(F.col("k") % 9 == 0, F.array(F.lit("x"))).otherwise(F.col("components")))
    return diff.diff_incidents(o.where(F.col("k") % 5 != 0).drop("k"), cur.drop("k")).drop("source_id")


def diff_docs(spark, d):
    k = F.col("doc_id")
    x = _read(spark, d, "documents").select(F.lit("documents").alias("source_id"), F.lit("r1").alias("extraction_rule_id"), F.when(k % 2 == 0, F.concat(F.lit("models["), k.cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("sections["), k.cast("string"), F.lit("]"))).alias("field_path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("value"), k)
    prev, cur = x.where(k % 10 != 0), x.where(k % 10 != 1).withColumn("value", F.when(k % 7 == 0, "changed").otherwise(F.col("value")))
    return diff.diff_docs(prev.drop("doc_id"), cur.drop("doc_id"), ["r1"]).drop("source_id")


def set_changes(spark, d):
    x = _read(spark, d, "documents").where(F.col("page_url").isNotNull())
    return diff.set_changes(x.where("doc_id % 3 <> 0"), x.where("doc_id % 3 <> 1"), ["page_url"])


def stance_changes(spark, d):
    c = _read(spark, d, "sources")
    flat = lambda x, m: x.select("source_id", F.explode(F.create_map(F.lit("auth"), F.col("auth"), F.lit("method"), m, F.lit("zone"), F.col("zone"))).alias("field", "value"))
    cur = flat(c, F.coalesce("method", F.lit("GET")))
    return diff.changed_keys(flat(c, F.col("method")), cur.withColumn("value", F.when((F.col("field") == "auth") & F.col("source_id").endswith("-status"), "none").otherwise(F.col("value"))), ["source_id", "field"], "value")


def mint_event_ids(spark, d):
    e = _read(spark, d, "change_events")
    key = I.key_text(F.col("provider"), F.col("model_id"), F.col("event_type"), F.lit("models[].id"), F.lit(None).cast("string"), events.json_value(F.col("model_id")))
    return e.select("row_id", key.alias("key"), I.event_id(key, F.col("observed_at")).alias("minted"))


def minted_and_excepted(spark, d):
    e = _read(spark, d, "change_events").select("row_id", "provider", F.col("model_id").alias("model"), F.when(F.col("event_type") != "correction.issued", F.col("event_type")).alias("event_type"), F.lit("models[].id").alias("field_path"), F.lit(None).cast("string").alias("old"), F.col("model_id").alias("new"), "observed_at")
    good, bad = events.mint(e)
    return bad.groupBy("reason", "event_type").agg(F.count(F.lit(1)).alias("n")).unionByName(good.groupBy(F.lit("minted").alias("reason"), "event_type").agg(F.count(F.lit(1)).alias("n")))


def evidence_union(spark, d):
    e = _read(spark, d, "change_events").select("id", "row_id", F.posexplode("evidence").alias("pos", "e")).select("id", "row_id", "pos", "e.source_id", "e.sha256_full", "e.url")
    return events.united_evidence(e, "id", ["source_id", "sha256_full"], ["row_id", "pos"]).select("id", "source_id", "sha256_full", "row_id", "url")


def dup_within_72h(spark, d):
    return events.repeated_within(_read(spark, d, "events").select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", ["event_id"]).select("event_id", "user_id", "event_type")


def candidates_72h(spark, d):
    e = _read(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return events.latest_within(e, e.where("event_type = 'purchase'"), ["user_id"], "ts", "event_id").select("event_id", "user_id", "candidate")


def reversal_pairs(spark, d):
    e = _read(spark, d, "change_events").where(F.col("event_type").isin("model.released", "model.deprecated") & F.col("model_id").isNotNull())
    gone = F.col("event_type") == "model.deprecated"
    m = e.select("provider", F.col("model_id").alias("model"), "event_type", F.lit("models[].id").alias("field_path"), F.when(gone, F.col("model_id")).alias("old"), F.when(~gone, F.col("model_id")).alias("new"), "observed_at")
    x = settled(events.mint(m)[0].select("id", "hash8", "inverse8", "observed_at"))
    at = lambda k: x.select("id", F.col(k).alias("k"), "observed_at")
    # The tables' reversals lie weeks apart.
    d = events.latest_within(at("inverse8"), at("hash8"), ["k"], "observed_at", "id", 24 * 60)
    return d.where(F.col("candidate").isNotNull()).select("id", F.col("candidate").alias("undone"))


def independent_sources(spark, d):
    e = _read(spark, d, "change_events").select("row_id", F.explode_outer("evidence.source_id").alias("source_id"))
    g = events.with_traits(e, "source_id", _read(spark, d, "sources")).groupBy("row_id").agg(F.collect_set("trait").alias("ts"))
    return g.select("row_id", events.any_independent(F.col("ts"), F.col("ts")).alias("independent"))


def robots_stance(spark, d):
    rules = "User-agent: *\nDisallow: /*-list$\nDisallow: /m*api\nDisallow: /mo*-docs\nAllow: /models\n\nUser-agent: probe\nUser-agent: watch\nDisallow: /\nAllow: /stat*s$"
    m = _read(spark, d, "manifests").select("row_id", "http_status", F.lit(rules).alias("robots"), F.concat(F.lit("/"), F.regexp_extract("url", "^[a-z]+://[^/]+/(.*)$", 1)).alias("at"))
    out = m
    for name, agent in (("reader", "reader/1.0"), ("watcher", "Watch/2 (+x)")):
        out = watch.stances(out, "robots", "at", agent, "http_status").withColumn(name, F.col("stance.allowed")).drop("stance")
    return out.select("row_id", "reader", "watcher")


def alias_index(spark, d):
    m = _read(spark, d, "model_aliases").select("canonical_id", F.col("canonical_id").alias("pos"), "aliases")
    return registry.alias_index(m)


def provider_of_models(spark, d):
    m = _read(spark, d, "openrouter_models").select("row_id", "id", F.lit("router").alias("namespace"))
    providers = _read(spark, d, "model_aliases").select(F.lit("router").alias("namespace"), F.col("provider").alias("prefix"), "provider").distinct()
    nothing = spark.createDataFrame([], "namespace string, alias string, canonical_id string")
    return registry.resolve_models(m, "id", nothing, providers).select("row_id", "provider")


def corrected_by(spark, d):
    return fold.corrected_by(_read(spark, d, "change_events")).select("id", F.array_join("correctors", ",").alias("correctors"))


def dangling_refs(spark, d):
    return integrity.check_store(_read(spark, d, "change_events"), _read(spark, d, "manifests"), _read(spark, d, "sources")).groupBy("code", "message").agg(F.count(F.lit(1)).alias("n"))


def seq_contiguity(spark, d):
    return integrity.gaps(_read(spark, d, "lineitem").where("l_linenumber <> 2 or l_orderkey % 3 = 0"), "l_orderkey", "l_linenumber").select("code", "subject")


def next_seq(spark, d):
    li = _read(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("seq"), "l_partkey", "l_suppkey", "l_extendedprice")
    new = li.where("seq > 3").drop("seq")
    return store.next_seq(new, li.where("seq <= 3").select("l_orderkey", "seq"), "l_orderkey", ["l_partkey", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_partkey", "l_suppkey", "seq")


def _chain(spark, d):
    kind = F.when(F.col("event_type") == "purchase", "confirm").when(F.col("event_type") == "error", "reject").when(F.col("event_type") == "signup", "discrepancy").otherwise(F.col("event_type"))
    e = _read(spark, d, "events").select(F.col("user_id").alias("event_id"), "ts", F.col("event_id").alias("seq"), kind.alias("kind"))
    v = F.col("kind").isin("confirm", "reject")
    return fold.chain(e.where(v), e.where(~v))


def fold_status(spark, d):
    return fold.fold(_chain(spark, d))


def running_status(spark, d):
    return fold.running(_chain(spark, d)).select("event_id", "seq", "status")


def status_as_of(spark, d):
    at = _read(spark, d, "events").where("event_type = 'view'").select(F.col("event_id").alias("i"), F.col("user_id").alias("event_id"), F.col("ts").alias("at"))
    return fold.as_of(_chain(spark, d), at, "i")


def derived_state(spark, d):
    c = _chain(spark, d)
    users = c.select(F.col("event_id").alias("id"), F.lit(None).cast("bigint").alias("correction_of"))
    v, a = c.where("rank = 1"), c.where("rank = 0")
    pub = a.where("kind = 'click'").select("event_id", F.lit("web").alias("surface"))
    s = fold.state(users, v, a, pub)
    return s.select("id", "status", "discrepancy_open", F.coalesce(F.element_at("published", F.lit("web")), F.lit(0)).alias("published"), "n_verdicts", "n_annotations")


def event_totals(spark, d):
    e = _read(spark, d, "change_events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("evidence")).alias("cited"), F.count_if(F.col("correction_of").isNotNull()).alias("corrections"), F.countDistinct("id").alias("ids"))


def latest_snapshot(spark, d):
    s = store.latest_snapshot(_read(spark, d, "statuspage_incidents"), "feed_id")
    return s.select("row_id", "feed_id", "id")


def absent_events(spark, d):
    e = _read(spark, d, "change_events").select("id", "row_id", "event_type")
    return store.absent(e.where("row_id % 2 = 0"), e.where("row_id % 2 = 1"), "id").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def cited_manifests(spark, d):
    e = _read(spark, d, "change_events").select("row_id", F.posexplode("evidence").alias("pos", "e")).select("row_id", F.col("pos").cast("bigint").alias("pos"), F.col("e.manifest_path").alias("manifest_path")).where(F.col("manifest_path").isNotNull())
    return store.existing_manifests(e, "manifest_path", _read(spark, d, "manifests")).select("row_id", "pos")


def sources_of_urls(spark, d):
    m = _read(spark, d, "manifests").select("row_id", F.concat(F.upper(F.substring("url", 1, 8)), F.expr("substring(url, 9)"), F.lit("#top")).alias("u"))
    return registry.source_for_url(m, "u", _read(spark, d, "sources")).select("row_id", "source_id")


def refused_urls(spark, d):
    m = _read(spark, d, "manifests").select("row_id", "url")
    return registry.refused(m, "url", _read(spark, d, "sources").where("lineage <> 'own'")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def source_kinds(spark, d):
    return _read(spark, d, "sources").select("source_id", registry.kind_of_snapshot(F.col("source_class"), F.col("source_id")).alias("kind"))


def canonical_urls(spark, d):
    u = _read(spark, d, "documents").where(F.col("page_url").isNotNull()).select("doc_id", F.concat("page_url", F.lit("?a=1&token=x#f")).alias("u"))
    return u.select("doc_id", U.canonical_url(F.col("u")).alias("url"), U.has_credential(F.col("u")).alias("secret"), F.array_join(U.credential_parameters(F.col("u")), ",").alias("names"))


def meter_tokens(spark, d):
    a = _read(spark, d, "azure_retail_prices").select("row_id", F.inline(F.array_compact(F.array(normalize.meter_fields(F.regexp_replace("meter_name", "[ _]", " "))))))
    return a.select("row_id", "direction", "tier", "scope", "model_ref")


def retail_rows(spark, d):
    return normalize.meter_rows(_read(spark, d, "azure_retail_prices")).groupBy("source_id", "direction", "tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))


def unpivot_costs(spark, d):
    p = _read(spark, d, "part").select(F.lit("part").alias("source_id"), F.to_json(F.create_map(F.concat(F.lit("m"), F.col("p_partkey").cast("string")), F.create_map(F.lit("input_cost_per_token"), F.col("p_size").cast("string"), F.lit("output_cost_per_token"), (F.col("p_size") * 2).cast("string"), F.lit("note"), F.col("p_brand")))).alias("payload"))
    return normalize.token_price_map(p).select("model_ref", "direction", "tier", "value")


def model_payloads(spark, d):
    m = _read(spark, d, "openrouter_models").select(F.col("row_id").cast("string").alias("source_id"), F.to_json(F.struct(F.array(F.struct("id", F.col("context_length"), F.struct("input_modalities", "output_modalities").alias("architecture"))).alias("data"))).alias("payload"))
    return normalize.models(m).select(F.col("source_id").cast("bigint").alias("row_id"), "id", "context_window", F.array_join("modalities", ",").alias("modalities"))


def incident_payloads(spark, d):
    s = _read(spark, d, "statuspage_incidents").select(F.col("row_id").cast("string").alias("source_id"), F.to_json(F.struct(F.array(F.struct("id", "status", "updated_at", "impact", "name", "shortlink", "components")).alias("incidents"))).alias("payload"))
    return normalize.incidents(s).select(F.col("source_id").cast("bigint").alias("row_id"), "id", "status", F.array_join("components", "|").alias("components"))


def keyword_lifecycle(spark, d):
    return _read(spark, d, "documents").select("doc_id", normalize.lifecycle(F.lower(F.coalesce("text", F.lit("")))).alias("state"))


def text_hashes(spark, d):
    return _read(spark, d, "documents").select("doc_id", I.text_hash(F.col("text")).alias("h"))


def slugs(spark, d):
    return _read(spark, d, "azure_retail_prices").select("row_id", I.slug(F.col("meter_name")).alias("slug"))


def email_scan(spark, d):
    x = _read(spark, d, "documents").select("doc_id", F.concat_ws(" ", "text", F.concat("source", F.lit("@"), "lang", F.lit(".example"))).alias("t"))
    return guards.emails(guards.text_lines(x, "doc_id", "t"), "doc_id", "line", "text").withColumn("line", F.col("line").cast("bigint"))


def write_scopes(spark, d):
    w = _read(spark, d, "manifests").select("row_id", F.col("source_id").alias("writer"), "path")
    scopes = spark.createDataFrame([("-status$", "manifests/evidence/"), ("^arbrix-", "manifests/"), ("-price-list$", "manifests/evidence/corvale")], "pattern string, prefix string")
    return guards.out_of_scope(w, scopes).select("row_id")


def rewritten_paths(spark, d):
    m = _read(spark, d, "manifests").select(F.concat(F.when(F.col("row_id") % 3 == 0, "A").when(F.col("row_id") % 3 == 1, "M").otherwise("R100"), F.lit("\t"), "path", F.when(F.col("row_id") % 3 == 2, F.concat(F.lit("\tother/"), F.col("row_id").cast("string"))).otherwise("")).alias("line"))
    return guards.rewrites(m, ["manifests/"])


def blocked_collection(spark, d):
    s = _read(spark, d, "sources").select(F.col("lineage").alias("host"), "source_id", (~F.col("excluded")).alias("allowed"))
    cur = s.withColumn("allowed", F.col("allowed") & ~F.col("source_id").endswith("-1"))
    return watch.collection_blocking(s, cur)


def pins_missed(spark, d):
    s = _read(spark, d, "sources")
    pins = s.select("source_id", F.when(F.col("zone").isNull(), "UTC").otherwise(F.col("zone")).alias("want"))
    return watch.pins_missed(pins, s.select("source_id", F.col("zone").alias("have")).where("have <> 'Asia/Tokyo'"), ["source_id"], "want", "have")


def sentences(spark, d):
    return _read(spark, d, "documents").select("doc_id", F.size(watch.sentences_with(F.coalesce("text", F.lit("")), "requests", "per minute")).cast("bigint").alias("n")).where("n > 0")


def quote_states(spark, d):
    q = watch.quote_state(_read(spark, d, "documents").where(F.col("text").isNotNull()), "text", "No data was lost", None)
    return q.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def section_names(spark, d):
    x = _read(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "text")).withColumn("level", F.when(F.col("text").startswith("# "), 2).otherwise(0))
    return pages.heading_sections(x, "doc_id", pages.Rule()).select("doc_id", F.col("n").cast("bigint").alias("n"), "name", F.length("text").cast("bigint").alias("chars"))


def _observed(spark, d):
    cols = ["row_id", "landed_at", "provider", "model_id", "event_type", "observed_at", "source_ids"]
    e = _read(spark, d, "change_events").withColumn("source_ids", F.col("evidence.source_id"))
    e = references.first_delivery(e, "id", cols)
    x = e.select("row_id", "landed_at", "provider", F.col("model_id").alias("model"), "event_type", F.lit("models[].id").alias("field_path"), F.when(F.col("event_type") == "model.deprecated", F.col("model_id")).alias("old"), F.when(F.col("event_type") != "model.deprecated", F.col("model_id")).alias("new"), "observed_at", "source_ids", F.lit(False).alias("absence"))
    # Each observation is dispatched at its own time; those of one change at one instant are one, with the sources of all.
    good, _ = events.identified(x)
    return events.with_sources(good, ["id", "observed_at"], "source_ids", ["landed_at", "row_id"], _read(spark, d, "sources"))


def corroborate_batch(spark, d):
    return corroborate.dispatch(_observed(spark, d))


def corroborate_stream(spark, d):
    """The rows of corroborate_batch from a stream over the same observations."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    rows = _observed(spark, d)
    rows.write.parquet(f"{folder}/in")
    ingest.replay(dispatch_stream(ingest.landed(spark, f"{folder}/in", rows.schema)), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema(corroborate.OUT).parquet(f"{folder}/out")


REFERENCE: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        diff_models, diff_prices, diff_row_counts, diff_status, diff_docs, set_changes, stance_changes, mint_event_ids, minted_and_excepted, evidence_union, dup_within_72h, candidates_72h, reversal_pairs,
        independent_sources, robots_stance, alias_index, provider_of_models, corrected_by, dangling_refs, seq_contiguity, next_seq, fold_status, running_status, status_as_of, derived_state, event_totals, latest_snapshot,
        absent_events, cited_manifests, sources_of_urls, refused_urls, source_kinds, canonical_urls, meter_tokens, retail_rows, unpivot_costs, model_payloads, incident_payloads, keyword_lifecycle, text_hashes, slugs,
        email_scan, write_scopes, rewritten_paths, blocked_collection, pins_missed, sentences, quote_states, section_names, corroborate_batch, corroborate_stream,
    )
}
