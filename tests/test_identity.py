"""Canonical values, ids, URLs, hashes and slugs."""

import hashlib
import json
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronodiff.functions import identity as I
from chronodiff.functions import urls as U

KEY = {"provider": "p", "canonical_model_id": None, "event_type": "price.changed", "normalized_field_path": "prices[]", "old_value": 1.0, "new_value": " x́ "}


def test_canonical_text():
    assert I.identity_json(KEY) == '{"canonical_model_id":null,"event_type":"price.changed","new_value":"x́","normalized_field_path":"prices[]","old_value":1,"provider":"p"}'
    assert I.short_hash({**KEY, "old_value": 1}) == I.short_hash(KEY)
    with pytest.raises(ValueError):
        I.identity_json({"provider": "p"})
    with pytest.raises(ValueError):
        I.canonical(float("nan"))


json_values = st.recursive(st.none() | st.booleans() | st.integers(-(10**6), 10**6) | st.text(max_size=8), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=5), x, max_size=3), max_leaves=8)


@settings(max_examples=100, deadline=None)
@given(json_values)
def test_canonical_form_is_stable(v):
    once = I.canonical_json(v)
    assert I.canonical_json(json.loads(once)) == once


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_columns_agree_with_python(spark):
    data = [("p", "m-1", "model.released", None, "m-1"), ("p", None, "outage.started", "2.5", 'quote"d'), (" q ", "m", "limits.changed", "128000", "1000000")]
    from chronodiff.operators.events import json_value

    d = spark.createDataFrame(data, "p string, m string, t string, o string, n string")
    key = I.key_text(F.col("p"), F.col("m"), F.col("t"), F.lit("a[].b"), json_value(F.col("o")), json_value(F.col("n")))
    num = lambda x: None if x is None else json.loads(x) if x[0].isdigit() else x
    for (p, m, t, o, n), r in zip(data, d.select(key.alias("k"), I.hash8(key).alias("h")).collect()):
        k = dict(provider=p, canonical_model_id=m, event_type=t, normalized_field_path="a[].b", old_value=num(o), new_value=num(n))
        assert r.k == I.identity_json(k) and r.h == I.short_hash(k)


def test_text_functions(spark):
    assert one(spark, "  a b\n\nc ", lambda c: I.collapse(c)) == "a b c"
    t = "é  x"
    assert one(spark, t, lambda c: I.text_hash(c)) == hashlib.sha256(" ".join(unicodedata.normalize("NFC", t).split()).encode()).hexdigest()[:16]
    assert one(spark, "Hello, World! " * 9, lambda c: I.slug(c)) == ("hello-world-" * 9)[:60].rstrip("-")
    assert one(spark, "!!", lambda c: I.slug(c)) == "untitled" and one(spark, "!!", lambda c: I.slug(c, None, "unknown")) == "unknown"
    assert one(spark, "2026-01-01T00:00:00Z", I.file_time) == "2026-01-01T00-00-00Z"
    assert one(spark, '{"b": 1.0, "a": [" x "]}', I.canonical_text) == '{"a":["x"],"b":1}' and one(spark, "{", I.canonical_text) is None


@pytest.mark.parametrize("url, canonical, secret", [("HTTPS://User:pw@Host.Example:443/A?b=1&api_key=2#f", "https://host.example/A?b=1", True), ("http://h:8080/x", "http://h:8080/x", False), ("https://h/p?q=sk-abcdefghijklmnopqrst", "https://h/p?q=sk-abcdefghijklmnopqrst", True), ("nothing", None, False), (None, None, None)])
def test_urls(spark, url, canonical, secret):
    assert one(spark, url, U.canonical_url) == canonical
    if url:
        assert one(spark, url, U.has_credential) == secret


def test_endpoints(spark):
    d = spark.createDataFrame([("https://h/a?x=1", "https://H/a?y=2", True), ("https://h/a", "http://h/a", False), ("https://h/a", "https://h/b", False), (None, "x", False)], "a string, b string, w boolean")
    assert all(r.g == r.w for r in d.select(U.same_endpoint(F.col("a"), F.col("b")).alias("g"), "w").collect())
