"""What changed between full snapshots (problem 2).

Method: a full outer join of each snapshot with the one before it on the primary key, comparing hashes of the canonical
row; a missing side is an addition or a removal, unequal hashes are a change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronodiff.functions import amounts as A


def row_hash(*columns: Column) -> Column:
    """One hash of canonical values, 128 bits as 16 bytes; null is a value of its own."""
    text = F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def snapshot_changes(rows: DataFrame, series: list[str], snapshot: str, run_ts: str, key: str, landed: list[str], state: Column) -> DataFrame:
    """(series..., snapshot, key, change) between adjacent snapshots of each series.

    ``rows`` holds all rows of all snapshots. Snapshots of a series are ordered by ``run_ts`` (ties: by ``snapshot``).
    Of several rows of one key in a snapshot the one with the greatest ``landed`` columns counts. A null key is a key
    like any other. A series' first snapshot gives no rows; empty input gives none. ``state``: what is compared.

    The rows shuffle once to deduplicate and once for the join, both on series, snapshot and key, so no series or key
    gathers in one task; the list of snapshots is one row per delivery.
    """
    r = rows.select(*series, F.col(snapshot).alias("_snap"), F.col(run_ts).alias("_run"), F.col(key).alias("_key"),
                    F.struct(*[F.col(c) for c in landed]).alias("_landed"), state.alias("_state"))
    last = r.groupBy(*series, "_snap", "_key").agg(F.max_by("_state", "_landed").alias("_state"))
    # From the rows themselves, in a scan of its own without what makes the state: combined before it shuffles.
    snaps = rows.groupBy(*series, F.col(snapshot).alias("_snap")).agg(F.max(run_ts).alias("_run"))
    order = W.partitionBy(*series).orderBy("_run", "_snap")
    snaps = snaps.select(*series, "_snap", F.lag("_snap").over(order).alias("_before"), F.lead("_snap").over(order).alias("_after"))
    known = snaps.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate([*series, "_snap"])], "_before", "_after")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate([*series, "_snap"])])
    at = last.join(known, same).drop(*[f"_s{i}" for i in range(len(series) + 1)])
    new = at.where(F.col("_before").isNotNull()).select(*series, "_snap", "_key", F.col("_state").alias("_new"), F.lit(True).alias("_in_new"))
    old = at.where(F.col("_after").isNotNull()).select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(series)], F.col("_after").alias("_osnap"),
                                                       F.col("_key").alias("_okey"), F.col("_state").alias("_old"), F.lit(True).alias("_in_old"))
    on = (F.col("_snap") == F.col("_osnap")) & F.col("_key").eqNullSafe(F.col("_okey"))
    for i, c in enumerate(series):
        on = on & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    change = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(F.col("_new") != F.col("_old"), "changed")
    both = new.join(old, on, "full_outer").withColumn("change", change).where(F.col("change").isNotNull())
    return both.select(*[F.coalesce(F.col(c), F.col(f"_o{i}")).alias(c) for i, c in enumerate(series)], F.coalesce("_snap", "_osnap").alias(snapshot),
                       F.when(F.col("_in_new").isNull(), F.col("_okey")).otherwise(F.col("_key")).alias(key), "change")


def price_state(models: DataFrame) -> DataFrame:
    """Rows of model snapshots with the prompt price as a canonical amount (`none` if there is no price)."""
    d = models.select("row_id", "feed_id", "snapshot_id", "run_ts", "id", "landed_at", F.col("pricing.prompt").alias("prompt"))
    d = A.with_price_text(d, "prompt", "usd")
    return d.withColumn("_value", F.coalesce(F.round(F.col("usd"), 8).cast("string"), F.lit("none")))


def status_state(incidents: DataFrame) -> DataFrame:
    """Rows of incident snapshots with the status in lower case without surrounding blanks."""
    status = F.regexp_replace(F.lower(F.col("status")), r"^[\s ]+|[\s ]+$", "")
    return incidents.select("row_id", "feed_id", "snapshot_id", "run_ts", "id", "landed_at", status.alias("_value"))


def record_changes(models: DataFrame, incidents: DataFrame) -> DataFrame:
    """(record_table, snapshot_id, record_id, change) of both snapshot tables."""
    rows = price_state(models).select(F.lit("openrouter_models").alias("record_table"), "*").drop("prompt", "usd")
    rows = rows.unionByName(status_state(incidents).select(F.lit("statuspage_incidents").alias("record_table"), "*"))
    d = snapshot_changes(rows, ["record_table", "feed_id"], "snapshot_id", "run_ts", "id", ["landed_at", "row_id"], row_hash(F.col("_value")))
    return d.select("record_table", "snapshot_id", F.col("id").alias("record_id"), "change")
