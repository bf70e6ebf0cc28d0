"""Running aggregates as of a row, against a plain double loop."""

import random

import pytest
from pyspark.sql import functions as F

from chronodiff.operators.asof import as_of


def brute(left, right, inclusive, null_safe):
    out = []
    for k, t, i in left:
        ok = [(rt, v) for rk, rt, v in right if rk == k and (k is not None or null_safe) and t is not None and (rt is None or rt < t or (inclusive and rt == t))]
        out.append((k, t, i, sum(v for _, v in ok) if ok else None, max((v for _, v in ok), default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [0.01, 0.9])
@pytest.mark.parametrize("inclusive, null_safe", [(True, False), (False, True), (True, True)])
def test_as_of(spark, share, inclusive, null_safe):
    r = random.Random(3)
    key = lambda: r.choice([None, "hot", "hot", "hot", *"abcdefgh"])
    time = lambda: r.choice([None, 5, *range(60)])
    left = [(key(), time(), i % 90) for i in range(300)]
    right = [(key(), time(), r.randrange(100)) for _ in range(200)]
    a = spark.createDataFrame(left, "k string, t bigint, i bigint")
    b = spark.createDataFrame(right, "k string, u bigint, v bigint")
    d = as_of(a, b, ["k"], F.col("t"), F.col("u"), {"n": (F.sum, F.col("v")), "m": (F.max, F.col("v"))}, inclusive=inclusive, null_safe=null_safe, share=share, ranges=8)
    assert d.columns == ["k", "t", "i", "n", "m"]
    assert sorted((tuple(x) for x in d.collect()), key=repr) == brute(left, right, inclusive, null_safe)


def test_as_of_nothing(spark):
    a = spark.createDataFrame([("x", 1)], "k string, t bigint")
    b = spark.createDataFrame([("x", 1, 2)], "k string, u bigint, v bigint")
    agg = {"n": (F.sum, F.col("v"))}
    assert [tuple(r) for r in as_of(a, b.limit(0), ["k"], F.col("t"), F.col("u"), agg).collect()] == [("x", 1, None)]
    assert as_of(a.limit(0), b, ["k"], F.col("t"), F.col("u"), agg).count() == 0
