"""Append-only chains folded into the state of each record, now or as of a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronodiff.operators.asof import as_of as running_as_of

#: Chain: (event_id, ts, rank, seq, kind); at one time annotations (rank 0) come before verdicts (rank 1).
DECIDES = {"confirm": "confirmed", "reject": "rejected"}
OPENS = "discrepancy"


def chain(verdicts: DataFrame, annotations: DataFrame) -> DataFrame:
    """One chain of both tables; columns (event_id, seq, kind, ts) each."""
    a = annotations.select("event_id", "ts", F.lit(0).alias("rank"), "seq", "kind")
    return a.unionByName(verdicts.select("event_id", "ts", F.lit(1).alias("rank"), "seq", "kind"))


def _place() -> Column:
    return F.struct("ts", "rank", "seq")


def _decision() -> Column:
    c = None
    for k, v in DECIDES.items():
        c = F.when(F.col("kind") == k, v) if c is None else c.when(F.col("kind") == k, v)
    return c


def fold(entries: DataFrame, key: str = "event_id") -> DataFrame:
    """(key, status, discrepancy_open) by aggregation: the last decision, and whether a discrepancy came after it."""
    d = _decision()
    g = entries.groupBy(key).agg(F.max_by(d, F.when(d.isNotNull(), _place())).alias("status"), F.max(F.when(d.isNotNull(), _place())).alias("_d"), F.max(F.when(F.col("kind") == OPENS, _place())).alias("_o"))
    return g.select(key, F.coalesce("status", F.lit("unconfirmed")).alias("status"), (F.col("_o").isNotNull() & (F.col("_d").isNull() | (F.col("_o") > F.col("_d")))).alias("discrepancy_open"))


def running(entries: DataFrame, key: str = "event_id") -> DataFrame:
    """The chain with the status after each entry."""
    w = W.partitionBy(key).orderBy("ts", "rank", "seq").rowsBetween(W.unboundedPreceding, 0)
    return entries.withColumn("status", F.coalesce(F.last(_decision(), True).over(w), F.lit("unconfirmed")))


def as_of(entries: DataFrame, at: DataFrame, identity: str, key: str = "event_id", ts: str = "at") -> DataFrame:
    """identity, status, discrepancy_open of each row of ``at`` (identity, key, ts): the fold of the entries up to that time.

    A row with a null time, a null key or no entry before it is unconfirmed.
    """
    d = _decision()
    place = F.struct(F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), "rank", "seq")
    known = running_as_of(at.select(identity, key, ts), entries, [key], F.unix_micros(F.col(ts).cast("timestamp")), F.unix_micros(F.col("ts").cast("timestamp")),
                          {"_d": (F.max, F.when(d.isNotNull(), F.struct(place.alias("place"), d.alias("status")))), "_o": (F.max, F.when(F.col("kind") == OPENS, place))})
    opened = F.col("_o").isNotNull() & (F.col("_d").isNull() | (F.col("_o") > F.col("_d.place")))
    return known.select(identity, F.coalesce("_d.status", F.lit("unconfirmed")).alias("status"), opened.alias("discrepancy_open"))


def flags(annotations: DataFrame, kinds: dict[str, str], key: str = "event_id") -> DataFrame:
    """(key, flag...) whether there is an annotation of each kind; keys without annotations aren't listed."""
    return annotations.groupBy(key).agg(*[F.coalesce(F.bool_or(F.col("kind") == k), F.lit(False)).alias(f) for f, k in kinds.items()])


def decisions(rows: DataFrame, rule: str, kind: str) -> DataFrame:
    """(rule, kind, n): how often each rule decided what."""
    return rows.groupBy(rule, kind).agg(F.count(F.lit(1)).alias("n"))


def counted(rows: DataFrame, key: str, by: str) -> DataFrame:
    """(key, counts): a map from ``by`` to the number of rows, in order of its keys."""
    n = rows.groupBy(key, by).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(by, "n")))).alias("counts"))


def corrected_by(events: DataFrame) -> DataFrame:
    """(id, correctors): the ids of the events that correct another, sorted."""
    c = events.where(F.col("correction_of").isNotNull())
    return c.groupBy(F.col("correction_of").alias("id")).agg(F.array_sort(F.collect_set("id")).alias("correctors"))


def state(events: DataFrame, verdicts: DataFrame, annotations: DataFrame, publications: DataFrame) -> DataFrame:
    """(id, status, discrepancy_open, rolled_back, mirrored, correctors, published, n_verdicts, n_annotations) of each event.

    A retraction goes before a correction, that before the decision.
    """
    f = fold(chain(verdicts, annotations)).withColumnRenamed("event_id", "id")
    fl = flags(annotations, {"rolled_back": "rollback", "mirrored": "mirror-corroborated", "retracted": "retraction"}).withColumnRenamed("event_id", "id")
    n = lambda d, c: d.groupBy(F.col("event_id").alias("id")).agg(F.count(F.lit(1)).alias(c))
    p = counted(publications, "event_id", "surface").withColumnRenamed("event_id", "id").withColumnRenamed("counts", "published")
    d = events.select("id").distinct()
    for other in (f, fl, corrected_by(events), p, n(verdicts, "n_verdicts"), n(annotations, "n_annotations")):
        d = d.join(other, "id", "left")
    false = F.lit(False)
    status = F.when(F.coalesce("retracted", false), "retracted").when(F.col("correctors").isNotNull(), "corrected").otherwise(F.coalesce("status", F.lit("unconfirmed")))
    return d.select("id", status.alias("status"), F.coalesce("discrepancy_open", false).alias("discrepancy_open"), F.coalesce("rolled_back", false).alias("rolled_back"), F.coalesce("mirrored", false).alias("mirrored"), "correctors", "published",
                    F.coalesce("n_verdicts", F.lit(0)).alias("n_verdicts"), F.coalesce("n_annotations", F.lit(0)).alias("n_annotations"))
