"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side of at most so many rows is sent to every executor; beyond it the join shuffles.
BROADCAST_ROWS = 20_000
#: A key with more than this share of the rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.01


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``rows`` rows, else ``df`` as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE, counts: DataFrame | None = None) -> DataFrame:
    """The keys of more than ``share`` of the rows of ``df``: at most ``1 / share`` rows. Counts are combined before the shuffle.

    ``counts``: (keys, _n) if the rows of each key are counted already.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if counts is None else counts
    # An empty table has a null total and so no hot key.
    total = counts.agg(F.sum("_n").alias("_total"), F.lit(1).alias("_one"))
    return counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").where(F.col("_n") > F.col("_total") * share).select(*keys)


def skew_left_join(left: DataFrame, right: DataFrame, keys: list[str], share: float = HOT_SHARE, counts: DataFrame | None = None) -> DataFrame:
    """``left`` left-joined to ``right``, of which each key has one row.

    Rows of hot keys meet a broadcast copy of the few right rows of these keys (at most ``1 / share``); all others
    shuffle. Null keys match nothing and stay. ``counts``: as for :func:`hot_keys`. Columns: those of ``left``, then those of ``right`` without the keys.
    """
    hot = hot_keys(left.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])), keys, share, counts)
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    tagged = left.join(hot, keys, "left")
    few = F.broadcast(right.join(hot.drop("_hot"), keys, "left_semi"))
    a = tagged.where(F.col("_hot")).drop("_hot").join(few, keys, "left")
    b = tagged.where(F.col("_hot").isNull()).drop("_hot").join(right, keys, "left")
    return a.unionByName(b)


def where_not_null(df: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` in which the computed ``column`` isn't null; it becomes the last column.

    A filter would be pushed below the projections that compute the column and repeat their expressions; the generator
    isn't.
    """
    return df.select(*[c for c in df.columns if c != column], F.explode(F.array_compact(F.array(column))).alias(column))
