"""Typed differences of canonical snapshots: one full outer join each, classified by null sides and unequal values.

A snapshot is a table of one series' rows; ``prev`` and ``cur`` hold any number of series (column ``source_id``), each once. Of
repeated keys the row with the greatest ``landed`` counts. A series that isn't in ``prev`` has its first run and no
deltas. Result columns: source_id, event_type (null: unclassified), field_path, delta_kind, subject, old, new (texts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESOLVED = ["resolved", "postmortem"]
DELTA = ["source_id", "event_type", "field_path", "delta_kind", "subject", "old", "new"]


def last_of(df: DataFrame, keys: list[str], landed: str | None) -> DataFrame:
    """One row per key: the greatest ``landed``; without it any one."""
    if landed is None:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(landed)).alias("_r")).select(*keys, "_r.*")


def outer(prev: DataFrame, cur: DataFrame, keys: list[str], landed: str | None = None) -> DataFrame:
    """keys, ``o`` and ``n`` (structs of the other columns, null where the side is missing) of the series with an earlier run."""
    sides = []
    for d, name in ((prev, "o"), (cur, "n")):
        d = last_of(d, ["source_id", *keys], landed)
        sides.append(d.select("source_id", *keys, F.struct(*[c for c in d.columns if c not in ("source_id", *keys)], F.lit(True).alias("_in")).alias(name)))
    known = prev.select("source_id").distinct()
    return sides[0].join(sides[1], ["source_id", *keys], "full_outer").join(known, "source_id", "left_semi")


def _kind() -> Column:
    return F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("modified")


def _delta(event: Column, path: Column, kind: Column, subject: Column, old: Column, new: Column) -> Column:
    text = lambda c: c.cast("string")
    return F.struct(text(event).alias("event_type"), path.alias("field_path"), kind.alias("delta_kind"), subject.alias("subject"), text(old).alias("old"), text(new).alias("new"))


def _flat(d: DataFrame, deltas: list[tuple[Column, Column]]) -> DataFrame:
    """A row for each (condition, delta) that holds."""
    found = F.array_compact(F.array(*[F.when(c, x) for c, x in deltas]))
    return d.select("source_id", F.explode(found).alias("_d")).select("source_id", "_d.*")


def diff_models(prev: DataFrame, cur: DataFrame, landed: str | None = None) -> DataFrame:
    """Snapshots (source_id, id, created, owned_by, endpoints, context_window)."""
    d = outer(prev, cur, ["id"], landed)
    both = F.col("o").isNotNull() & F.col("n").isNotNull()
    i = F.col("id")
    ends = lambda s: F.to_json(F.array_sort(F.coalesce(F.col(f"{s}.endpoints"), F.array().cast("array<string>"))))
    differ = lambda f: both & ~F.col(f"o.{f}").eqNullSafe(F.col(f"n.{f}"))
    lit, mod = F.lit, F.lit("modified")
    return _flat(d, [
        (F.col("o").isNull(), _delta(lit("model.released"), lit("models[].id"), lit("added"), i, lit(None), i)),
        (F.col("n").isNull(), _delta(lit("model.deprecated"), lit("models[].id"), lit("removed"), i, i, lit(None))),
        (differ("context_window"), _delta(lit("limits.changed"), lit("models[].context_window"), mod, i, F.col("o.context_window"), F.col("n.context_window"))),
        (both & (ends("o") != ends("n")), _delta(lit("capability.changed"), lit("models[].endpoints"), mod, i, ends("o"), ends("n"))),
        (differ("created"), _delta(lit(None), lit("models[].created"), mod, i, F.col("o.created"), F.col("n.created"))),
        (differ("owned_by"), _delta(lit(None), lit("models[].owned_by"), mod, i, F.col("o.owned_by"), F.col("n.owned_by"))),
    ])


def price_rows(prev: DataFrame, cur: DataFrame, landed: str | None = None) -> DataFrame:
    return outer(prev, cur, ["model_ref", "direction", "tier", "region"], landed)


def changed_prices(rows: DataFrame) -> DataFrame:
    """(source_id, model_ref, direction, entries, old, new): the changed prices of a model and direction in order of tier and region.

    ``old`` and ``new`` are those of the first standard entry, else of the first entry.
    """
    c = rows.where(F.col("o").isNotNull() & F.col("n").isNotNull() & ~F.col("o.value").eqNullSafe(F.col("n.value")))
    e = F.array_sort(F.collect_list(F.struct("tier", "region", F.col("o.value").alias("old"), F.col("n.value").alias("new")))).alias("entries")
    g = c.groupBy("source_id", "model_ref", "direction").agg(e)
    first = F.coalesce(F.get(F.filter("entries", lambda x: x.tier == "standard"), F.lit(0)), F.get("entries", F.lit(0)))
    return g.withColumn("_r", first).select("source_id", "model_ref", "direction", "entries", F.col("_r.old").alias("old"), F.col("_r.new").alias("new"))


def price_row_counts(rows: DataFrame) -> DataFrame:
    """(source_id, model_ref, added, removed, kind) of the models whose price rows appeared or went."""
    g = rows.groupBy("source_id", "model_ref").agg(F.count_if(F.col("o").isNull()).alias("added"), F.count_if(F.col("n").isNull()).alias("removed"))
    kind = F.when(F.col("removed") == 0, "added").when(F.col("added") == 0, "removed").otherwise("modified")
    return g.where(F.col("added") + F.col("removed") > 0).withColumn("kind", kind)


def diff_prices(prev: DataFrame, cur: DataFrame, landed: str | None = None) -> DataFrame:
    """Snapshots (source_id, model_ref, direction, tier, region, value); the joined rows are used for both kinds of delta."""
    rows = price_rows(prev, cur, landed)
    null = F.lit(None).cast("string")
    a = changed_prices(rows).select("source_id", F.lit("price.changed").alias("event_type"), F.concat(F.lit("prices[direction="), "direction", F.lit("].value")).alias("field_path"), F.lit("modified").alias("delta_kind"),
                                    F.col("model_ref").alias("subject"), F.col("old").cast("string").alias("old"), F.col("new").cast("string").alias("new"))
    b = price_row_counts(rows).select("source_id", null.alias("event_type"), F.lit("prices[]").alias("field_path"), F.col("kind").alias("delta_kind"), F.col("model_ref").alias("subject"), null.alias("old"), null.alias("new"))
    return a.unionByName(b)


def diff_incidents(prev: DataFrame, cur: DataFrame, landed: str | None = None) -> DataFrame:
    """Snapshots (source_id, id, status, components); an incident that left the window gives nothing."""
    d = outer(prev, cur, ["id"], landed).where(F.col("n").isNotNull())
    both = F.col("o").isNotNull()
    parts = lambda s: F.to_json(F.array_sort(F.coalesce(F.col(f"{s}.components"), F.array().cast("array<string>"))))
    resolved = both & F.coalesce(F.col("n.status").isin(RESOLVED), F.lit(False)) & ~F.coalesce(F.col("o.status").isin(RESOLVED), F.lit(False))
    return _flat(d, [
        (~both, _delta(F.lit("outage.started"), F.lit("incidents[].id"), F.lit("added"), F.col("id"), F.lit(None), F.col("id"))),
        (resolved, _delta(F.lit("outage.resolved"), F.lit("incidents[].status"), F.lit("modified"), F.col("id"), F.col("o.status"), F.col("n.status"))),
        (both & (parts("o") != parts("n")), _delta(F.lit(None), F.lit("incidents[].components"), F.lit("modified"), F.col("id"), parts("o"), parts("n"))),
    ])


def diff_docs(prev: DataFrame, cur: DataFrame, typed_rules: list[str], landed: str | None = None) -> DataFrame:
    """Snapshots (source_id, extraction_rule_id, field_path, value). Models added or removed are typed where the rule declares it."""
    d = outer(prev, cur, ["field_path"], landed)
    path = F.col("field_path")
    rules = cur.groupBy("source_id").agg(F.max("extraction_rule_id").alias("_rule"))
    d = d.join(rules, "source_id", "left")
    model = F.nullif(F.regexp_extract(path, r"^models\[(.+)\]$", 1), F.lit(""))
    typed = model.isNotNull() & F.coalesce(F.col("_rule").isin(typed_rules), F.lit(False)) & (F.col("o").isNull() | F.col("n").isNull())
    subject = F.coalesce(model, path)
    changed = F.col("o").isNull() | F.col("n").isNull() | ~F.col("o.value").eqNullSafe(F.col("n.value"))
    return _flat(d, [
        (typed, _delta(F.when(F.col("o").isNull(), "model.released").otherwise("model.deprecated"), F.lit("models[].id"), _kind(), model, F.when(F.col("n").isNull(), model), F.when(F.col("o").isNull(), model))),
        (changed & ~typed, _delta(F.lit(None), path, _kind(), subject, F.col("o.value"), F.col("n.value"))),
    ])


def changed_keys(prev: DataFrame, cur: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, old, new of a map-like table wherever the value differs or a side is missing."""
    o, n = prev.select(*keys, F.col(value).alias("old"), F.lit(1).alias("_o")), cur.select(*keys, F.col(value).alias("new"), F.lit(1).alias("_n"))
    d = o.join(n, keys, "full_outer")
    return d.where(F.col("_o").isNull() | F.col("_n").isNull() | ~F.col("old").eqNullSafe(F.col("new"))).select(*keys, "old", "new")


def set_changes(prev: DataFrame, cur: DataFrame, keys: list[str]) -> DataFrame:
    """keys, change (`new` or `removed`)."""
    new = cur.select(keys).distinct().join(prev.select(keys), keys, "left_anti").withColumn("change", F.lit("new"))
    return new.unionByName(prev.select(keys).distinct().join(cur.select(keys), keys, "left_anti").withColumn("change", F.lit("removed")))


DIFFERS = {"models-api": diff_models, "pricing-api": diff_prices, "statuspage": diff_incidents, "docs-html": diff_docs}
