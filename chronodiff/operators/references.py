"""References to records that do not exist (problem 4).

Method: every change is a signed delta of one key, +1/-1 reference and +1/-1 existence. Counts per key are the sum of the
deltas up to a time; a reference whose key has no existence at the time of the reference is an orphan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronodiff.operators.asof import as_of
from chronodiff.session import settled

STATE = "target_table string, key string, refs bigint, existence bigint, first_at timestamp, gone_at timestamp"


def first_delivery(df: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """Of the rows of each key the one that landed first (ties: the smaller ``row_id``). The extra columns follow it."""
    return df.groupBy(key).agg(F.min_by(F.struct(*keep), F.struct("landed_at", "row_id")).alias("_r")).select(key, "_r.*")


def references(events: DataFrame) -> DataFrame:
    """(event_id, pos, field, target_table, key, period, landed_at): one row per reference that isn't null."""
    # Only the two cited fields are read and moved, not the whole evidence.
    cited = F.arrays_zip(F.col("evidence.source_id").alias("source_id"), F.col("evidence.manifest_path").alias("manifest_path"))
    slim = events.where(F.col("id").isNotNull()).select("id", "row_id", "observed_at", "landed_at", "correction_of", cited.alias("evidence"))
    first = first_delivery(slim, "id", ["observed_at", "landed_at", "correction_of", "evidence"])
    base = [F.col("id").alias("event_id"), F.date_format("observed_at", "yyyy-MM").alias("period"), "landed_at"]
    ev = first.select(*base, F.posexplode("evidence").alias("pos", "e"))
    fields = F.array(
        F.struct(F.lit("source_id").alias("field"), F.lit("sources").alias("target_table"), F.col("e.source_id").alias("key")),
        F.struct(F.lit("manifest_path").alias("field"), F.lit("manifests").alias("target_table"), F.col("e.manifest_path").alias("key")),
    )
    ev = ev.select("event_id", "period", "landed_at", F.col("pos").cast("bigint").alias("pos"), F.inline(fields))
    co = first.select(*base, F.lit(-1).cast("bigint").alias("pos"), F.lit("correction_of").alias("field"), F.lit("change_events").alias("target_table"), F.col("correction_of").alias("key"))
    return ev.unionByName(co).where(F.col("key").isNotNull())


def targets(sources: DataFrame, manifests: DataFrame, events: DataFrame) -> DataFrame:
    """(target_table, key, at, gone_at): each existing key with its arrival and, if any, its end."""
    m = first_delivery(manifests.where(F.col("path").isNotNull()), "path", ["landed_at", "deleted_at"])
    e = first_delivery(events.where(F.col("id").isNotNull()), "id", ["landed_at"])
    s = sources.where(F.col("source_id").isNotNull()).groupBy(F.col("source_id").alias("key")).agg(F.min_by(F.struct("added_at", "removed_at"), "added_at").alias("_r"))
    cols = ["target_table", "key", "at", "gone_at"]
    s = s.select(F.lit("sources").alias("target_table"), "key", F.col("_r.added_at").alias("at"), F.col("_r.removed_at").alias("gone_at"))
    m = m.select(F.lit("manifests").alias("target_table"), F.col("path").alias("key"), F.col("landed_at").alias("at"), F.col("deleted_at").alias("gone_at"))
    e = e.select(F.lit("change_events").alias("target_table"), F.col("id").alias("key"), F.col("landed_at").alias("at"), F.lit(None).cast("timestamp").alias("gone_at"))
    return s.select(cols).unionByName(m.select(cols)).unionByName(e.select(cols))


def deltas(refs: DataFrame, existing: DataFrame) -> DataFrame:
    """(target_table, key, refs, existence, at): the signed changes. A target with an end gives +1 at its arrival and -1 at its end."""
    cols = ["target_table", "key", "refs", "existence", "at"]
    r = refs.select("target_table", "key", F.lit(1).alias("refs"), F.lit(0).alias("existence"), F.col("landed_at").alias("at"))
    born = existing.select("target_table", "key", F.lit(0).alias("refs"), F.lit(1).alias("existence"), "at")
    gone = existing.where(F.col("gone_at").isNotNull()).select("target_table", "key", F.lit(0).alias("refs"), F.lit(-1).alias("existence"), F.col("gone_at").alias("at"))
    return r.select(cols).unionByName(born.select(cols)).unionByName(gone.select(cols))


def merge_counts(changes: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The state of each key: summed references and existence, first arrival and last end.

    ``state`` is an earlier result to which ``changes`` are added, so that the report is maintained from deltas alone.
    A key of a third of all changes is combined before the shuffle.
    """
    d = changes.select("target_table", "key", F.col("refs").cast("bigint"), F.col("existence").cast("bigint"),
                       F.when(F.col("existence") > 0, F.col("at")).alias("first_at"), F.when(F.col("existence") < 0, F.col("at")).alias("gone_at"))
    if state is not None:
        d = d.unionByName(state.select(d.columns))
    return d.groupBy("target_table", "key").agg(F.sum("refs").alias("refs"), F.sum("existence").alias("existence"), F.min("first_at").alias("first_at"), F.max("gone_at").alias("gone_at"))


def orphan_keys(state: DataFrame) -> DataFrame:
    """The current report: keys with references and no existence."""
    return state.where((F.col("refs") > 0) & (F.col("existence") <= 0)).select("target_table", "key", "refs", "first_at", "gone_at")


def orphans(refs: DataFrame, existing: DataFrame) -> DataFrame:
    """(event_id, pos, field, period, kind) of every reference without a valid target at its own landing time.

    The count decides: the signed existence of the key summed up to the reference (changes at the same instant count,
    so an arrival then is in time and an end then is over). A key may arrive and end any number of times; one that was
    delivered again is there again. Nothing left is an orphan: ``missing`` if the key never arrives, ``late`` if it
    arrives only afterwards, else ``deleted``. An arrival without a time is none.
    """
    born = existing.where(F.col("at").isNotNull())
    signed = deltas(refs.limit(0), born).select("target_table", "key", F.unix_micros("at").alias("_at"), F.col("existence").cast("bigint").alias("existence"), F.when(F.col("existence") > 0, 1).otherwise(0).cast("bigint").alias("births"), F.lit(0).cast("bigint").alias("ever"))
    # Known from the beginning: that the key will be there at some time.
    ever = born.select("target_table", "key", F.lit(None).cast("bigint").alias("_at"), F.lit(0).cast("bigint").alias("existence"), F.lit(0).cast("bigint").alias("births"), F.lit(1).cast("bigint").alias("ever"))
    # Written once each for the counts, the cut points and the sums.
    d = as_of(settled(refs), settled(signed.unionByName(ever)), ["target_table", "key"], F.unix_micros("landed_at"), F.col("_at"), {c: (F.sum, F.col(c)) for c in ("existence", "births", "ever")})
    kind = F.when(F.coalesce("existence", F.lit(0)) <= 0, F.when(F.coalesce("ever", F.lit(0)) == 0, "missing").when(F.coalesce("births", F.lit(0)) == 0, "late").otherwise("deleted"))
    return d.withColumn("kind", kind).where(F.col("kind").isNotNull()).select("event_id", "pos", "field", "period", "kind")


def orphan_references(events: DataFrame, manifests: DataFrame, sources: DataFrame) -> DataFrame:
    return orphans(references(events), targets(sources, manifests, events))


def orphans_now(events: DataFrame, manifests: DataFrame, sources: DataFrame) -> DataFrame:
    """:func:`orphan_keys` after all changes in the tables."""
    return orphan_keys(merge_counts(deltas(references(events), targets(sources, manifests, events))))


def orphan_report(found: DataFrame) -> DataFrame:
    """(field, period, kind, n): orphans per referring field and month."""
    return found.groupBy("field", "period", "kind").agg(F.count(F.lit(1)).alias("n"))
