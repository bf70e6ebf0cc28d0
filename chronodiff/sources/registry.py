"""Registries of sources and of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronodiff.functions.urls import canonical_url, host
from chronodiff.operators.joins import bounded, skew_left_join


def sources_of(doc: DataFrame) -> DataFrame:
    """One row per entry of a registry document (column ``sources``, an array of structs); a repeated id raises."""
    s = doc.select(F.explode("sources").alias("s")).select("s.*")
    n = s.groupBy("source_id").agg(F.count(F.lit(1)).alias("_n"))
    return s.join(n, "source_id").withColumn("source_id", F.when(F.col("_n") > 1, F.raise_error("a source id occurs twice")).otherwise(F.col("source_id"))).drop("_n")


def source_for_url(urls: DataFrame, url: str, sources: DataFrame) -> DataFrame:
    """``urls`` with the source_id whose registered URL is the same in canonical form (of several the smallest), or null."""
    s = sources.groupBy(canonical_url(F.col("url")).alias("_u")).agg(F.min("source_id").alias("source_id"))
    return urls.withColumn("_u", canonical_url(F.col(url))).join(s, "_u", "left").drop("_u")


def alias_index(entries: DataFrame) -> DataFrame:
    """(namespace, alias, canonical_id): of an alias listed by several entries the last entry (by ``pos``) counts."""
    e = entries.select("canonical_id", "pos", F.explode("aliases").alias("namespace", "names")).select("canonical_id", "pos", "namespace", F.explode("names").alias("alias"))
    return e.groupBy("namespace", "alias").agg(F.max_by("canonical_id", F.struct("pos", "canonical_id")).alias("canonical_id"))


def resolve_provider(model: Column, prefixes: dict[str, str], namespaces: Column | None = None, order: list[str] = ()) -> Column:
    """Provider of a model reference: its prefix if that is known, else the first of ``order`` that lists it."""
    prefix = F.split_part(model, F.lit("/"), F.lit(1))
    table = F.create_map(*[F.lit(v) for kv in prefixes.items() for v in kv]) if prefixes else F.create_map(F.lit(""), F.lit(None).cast("string"))
    found = [F.when(model.contains("/"), F.element_at(table, prefix))]
    if namespaces is not None:
        found += [F.when(F.array_contains(namespaces, n), F.lit(n)) for n in order]
    return F.coalesce(*found)


def resolve_models(refs: DataFrame, model: str, aliases: DataFrame, providers: DataFrame) -> DataFrame:
    """``refs`` (with ``namespace``) with ``canonical_id`` and ``provider`` of their model.

    The canonical id is the alias' in its namespace, exactly as written. The provider is that of the namespace and the
    model's prefix (what stands before its first `/`), else that of the whole namespace (prefix ''). Unknown ones are null.
    """
    known = aliases.select("namespace", F.col("alias").alias("_a"), "canonical_id")
    d = skew_left_join(refs.withColumn("_a", F.col(model)), known, ["namespace", "_a"]).drop("_a")
    p = providers.groupBy("namespace", F.coalesce("prefix", F.lit("")).alias("_p")).agg(F.min("provider").alias("_v"))
    prefix = F.when(F.col(model).contains("/"), F.split_part(F.col(model), F.lit("/"), F.lit(1)))
    d = d.withColumn("_p", prefix).join(bounded(p), ["namespace", "_p"], "left").withColumnRenamed("_v", "_own").drop("_p")
    whole = bounded(p.where("_p = ''").select("namespace", F.col("_v").alias("_all")))
    return d.join(whole, "namespace", "left").withColumn("provider", F.coalesce("_own", "_all")).drop("_own", "_all")


def provider_of_entries(entries: DataFrame, order: list[tuple[str, str]]) -> DataFrame:
    """(canonical_id, provider): that of the first namespace in ``order`` in which an entry has aliases; null if none."""
    found = F.coalesce(*[F.when(F.map_contains_key("aliases", ns), F.lit(p)) for ns, p in order])
    return entries.select("canonical_id", found.alias("provider"))


def with_sidecar(deltas: DataFrame, sidecar: DataFrame, keys: list[str]) -> DataFrame:
    """Deltas with what their snapshot says beside its rows (``keys`` and other columns); a delta without has nulls. Of several rows of a key the smallest as JSON counts."""
    rest = [c for c in sidecar.columns if c not in keys]
    one = sidecar.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("_s")).select(*keys, "_s.*")
    return skew_left_join(deltas, one, keys)


def hosts_to_sources(sources: DataFrame) -> DataFrame:
    """(host, source_ids): the sources of each host, sorted; what a sweep over hosts may ask, so excluded hosts, and sources that are excluded or never fetched, aren't there."""
    d = sources.withColumn("host", host(F.col("url"))).where(F.col("host").isNotNull())
    d = d.where(~F.coalesce("excluded", F.lit(False)) & F.col("method").isNotNull())
    d = d.join(bounded(excluded_hosts(sources)), "host", "left_anti")
    return d.groupBy("host").agg(F.array_sort(F.collect_set("source_id")).alias("source_ids"))


def source_of_manifest(path: Column) -> Column:
    """The source id in a manifest's path, `manifests/evidence/<source>/<file>.meta.json`; null if it is none."""
    return F.nullif(F.regexp_extract(path, r"^manifests/evidence/([^/]+)/[^/]+\.meta\.json$", 1), F.lit(""))


def excluded_hosts(sources: DataFrame) -> DataFrame:
    return sources.where("excluded").select(host(F.col("url")).alias("host")).where(F.col("host").isNotNull()).distinct()


def refused(requests: DataFrame, url: str, sources: DataFrame) -> DataFrame:
    """Requests with ``reason``: why the URL may not be fetched (unregistered host, excluded host), or null."""
    hosts = sources.select(host(F.col("url")).alias("_h"), "excluded").where(F.col("_h").isNotNull()).groupBy("_h").agg(F.max("excluded").alias("_x"))
    d = requests.withColumn("_h", host(F.col(url))).join(hosts, "_h", "left")
    return d.withColumn("reason", F.when(F.col("_x").isNull(), "unregistered host").when(F.col("_x"), "excluded host")).drop("_h", "_x")


def redirect_violations(chains: DataFrame, key: str, hops: str, sources: DataFrame) -> DataFrame:
    """(key, hop, reason) of each hop of a redirect chain to a host that isn't registered or is excluded."""
    h = chains.select(key, F.explode(hops).alias("hop"))
    return refused(h, "hop", sources).where(F.col("reason").isNotNull()).select(key, "hop", "reason")


def kind_of_snapshot(source_class: Column, source_id: Column) -> Column:
    """Kind of a source's snapshots: by its class, and for listings by whether its id names prices; probes have none."""
    prices = F.lower(source_id).rlike("price|pricing|retail")
    return (
        F.when(source_class == "statuspage", "statuspage")
        .when(source_class.isin("provider-docs", "policy-page"), "docs-html")
        .when(source_class.isin("official-api", "third-party-aggregator"), F.when(prices, "pricing-api").otherwise("models-api"))
    )
