"""Running aggregates of one table as of each row of another, without pairs.

Both tables are laid into one and ordered by time inside a key, so a key costs its rows, not its pairs. A key that holds
more than a hundredth of all rows is cut into ranges of time of about equal size, and what the earlier ranges add up to
is carried into each, so no key is one task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronodiff.operators.joins import HOT_SHARE, hot_keys

#: Ranges of time that a hot key is cut into.
RANGES = 128


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: Column, right_at: Column, aggs: dict[str, tuple[Callable[[Column], Column], Column]], tie: Column | None = None, right_tie: Column | None = None, inclusive: bool = True, null_safe: bool = False, share: float = HOT_SHARE, ranges: int = RANGES) -> DataFrame:
    """The columns of ``left`` and, of the rows of ``right`` with the same keys up to its time, the aggregates ``aggs``.

    ``aggs``: name -> (``F.sum``, ``F.max`` or ``F.min``, a column of ``right``); null where no row qualifies. ``at``
    and ``right_at`` are whole numbers; ``tie`` and ``right_tie`` order rows of one time. ``inclusive``: rows of
    ``right`` at the same time (and tie) count. A row of ``right`` without time holds from the beginning. A row of
    ``left`` without time, or (unless ``null_safe``) with a null key, meets nothing and stays; rows of ``right`` with such
    a key are left out. Repeated rows stay and count each.

    One shuffle by key for all rows; counts, cut points and carried sums are combined before they shuffle.
    """
    named, values = [f"_k{i}" for i in range(len(keys))], [f"_v{i}" for i in range(len(aggs))]
    fold = list(zip([f for f, _ in aggs.values()], values))
    no_tie = F.lit(0)
    rights = right.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], right_at.cast("bigint").alias("_t"), (no_tie if right_tie is None else right_tie).alias("_tie"), F.lit(0).alias("_s"), *[c.alias(v) for (_, c), v in zip(aggs.values(), values)])
    lefts = left.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], at.cast("bigint").alias("_t"), (no_tie if tie is None else tie).alias("_tie"), F.lit(1 if inclusive else -1).alias("_s"), F.struct(*left.columns).alias("_row"))
    empty = {n: F.lit(None).cast(d.schema[n].dataType) for d in (rights, lefts) for n in d.columns}
    lefts = lefts.withColumns({v: empty[v] for v in values})
    rights = rights.withColumn("_row", empty["_row"])
    apart = F.col("_t").isNull()
    if not null_safe:
        unknown = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in named])
        rights, apart = rights.where(~unknown), apart | unknown
    rows = lefts.where(~apart).unionByName(rights)

    # Cut points of the times of hot keys: at most ranges - 1 for each of at most 1 / share keys.
    hot = F.broadcast(hot_keys(rows, named, share).select(F.struct(*named).alias("_hot")))
    key = F.struct(*named)
    cut = F.percentile_approx("_t", [i / ranges for i in range(1, ranges)], 10 * ranges)
    cuts = rows.select(key.alias("_hot"), "_t").join(hot, "_hot").groupBy("_hot").agg(F.array_distinct(cut).alias("_cuts"))
    rows = rows.join(F.broadcast(cuts), key == F.col("_hot"), "left").drop("_hot")
    rows = rows.withColumn("_range", F.when(F.col("_cuts").isNull() | F.col("_t").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_t")))))
    sums = rows.where(F.col("_cuts").isNotNull()).groupBy(*named, "_range").agg(*[f(v).alias(v) for f, v in fold])
    before = W.partitionBy(*named).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(*named, "_range", *[f(v).over(before).alias(v) for f, v in fold], empty["_t"].alias("_t"), empty["_tie"].alias("_tie"), F.lit(0).alias("_s"), empty["_row"].alias("_row"))

    upto = W.partitionBy(*named, "_range").orderBy(F.col("_t").asc_nulls_first(), F.col("_tie").asc_nulls_first(), "_s").rowsBetween(W.unboundedPreceding, 0)
    done = rows.drop("_cuts").unionByName(carried).select("_row", "_s", *[f(v).over(upto).alias(v) for f, v in fold]).where(F.col("_s") != 0)
    out = done.select("_row", *values).unionByName(lefts.where(apart).select("_row", *values))
    return out.select("_row.*", *[F.col(v).alias(n) for v, n in zip(values, aggs)])
