"""JSON Schema columns: each keyword with texts that fit and texts that don't."""

import json

import pytest
from pyspark.sql import functions as F

from chronodiff.operators import schemas as S

ITEM = {"$id": "urn:item", "type": "object", "required": ["url"], "properties": {"url": {"format": "uri"}, "at": {"format": "date-time"}}, "additionalProperties": {"type": "number"}}
CASES = [
    ({"type": ["integer", "null"]}, [(1, []), (1.0, []), (None, []), (1.5, ["/: not of type integer or null"]), ("1", ["/: not of type integer or null"]), (True, ["/: not of type integer or null"])]),
    ({"type": "number"}, [(1, []), (2.5, []), (1e300, []), ("x", ["/: not of type number"])]),
    ({"enum": ["a", 1, None, True]}, [("a", []), (1, []), (None, []), (True, []), ("1", ["/: not one of the values"]), (False, ["/: not one of the values"])]),
    ({"const": {"b": [1], "a": "x"}}, [({"a": "x", "b": [1]}, []), ({"a": "x"}, ["/: not the value"])]),
    ({"minLength": 2, "maxLength": 3, "pattern": "^a"}, [("ab", []), ("a", ["/: too short"]), ("bbbb", ["/: does not match the pattern", "/: too long"]), (5, [])]),
    ({"minimum": 0, "exclusiveMaximum": 10}, [(0, []), (9.99, []), (10, ["/: too great"]), (-1, ["/: too small"]), ("x", [])]),
    ({"items": {"type": "string"}, "minItems": 1, "maxItems": 2, "uniqueItems": True}, [(["a"], []), ([], ["/: too few items"]), (["a", "a"], ["/: items are not unique"]), ([1, "b", None], ["/0: not of type string", "/2: not of type string", "/: too many items"]), ({}, [])]),
    ({"properties": {"a": {"properties": {"b": {"items": {"properties": {"c": {"type": "boolean"}}}}}}}}, [({"a": {"b": [{"c": True}, {"c": 1}]}}, ["/a/b/1/c: not of type boolean"]), ({"a": {"b": "x"}}, [])]),
    ({"required": ["x y", "b"], "minProperties": 2, "additionalProperties": False, "properties": {"x y": True, "b": False}}, [({"x y": 1}, ["/: b is missing", "/: too few members"]), ({"x y": 1, "b": 2, "c": 3}, ["/: unknown c", "/b: not allowed"])]),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, [("x", []), (6, []), (3, ["/: fits none of the alternatives"])]),
    ({"oneOf": [{"type": "integer"}, {"minimum": 5}]}, [(3, []), (5.5, []), (6, ["/: does not fit exactly one of the alternatives"])]),
    ({"allOf": [{"minimum": 1}, {"maximum": 2}], "not": {"const": 2}}, [(1, []), (3, ["/: too great"]), (2, ["/: fits what it must not"])]),
    ({"if": {"properties": {"k": {"const": "a"}}, "required": ["k"]}, "then": {"required": ["x"]}, "else": {"required": ["y"]}}, [({"k": "a", "x": 1}, []), ({"k": "a"}, ["/: x is missing"]), ({"k": "b"}, ["/: y is missing"]), ({"y": 1}, [])]),
    ({"properties": {"e": {"items": {"$ref": "urn:item"}}, "n": {"$ref": "#/$defs/n"}}, "$defs": {"n": {"type": "integer"}}}, [({"e": [{"url": "https://h/x", "at": "2026-07-01T00:00:00Z", "z": 1}], "n": 1}, []), ({"e": [{"at": "2026-07-01T00:00:00", "z": "q"}, {"url": "h x"}], "n": "1"}, ["/e/0/at: not a date-time", "/e/0/z: not of type number", "/e/0: url is missing", "/e/1/url: not a uri", "/n: not of type integer"])]),
]


@pytest.mark.parametrize("schema, values", CASES)
def test_keywords(spark, schema, values):
    d = spark.createDataFrame([(i, json.dumps(v)) for i, (v, _) in enumerate(values)], "i int, t string")
    out = {r.i: r.e for r in d.select("i", S.schema_errors(F.col("t"), schema, S.catalogue([ITEM])).alias("e")).collect()}
    assert out == {i: sorted(w) for i, (_, w) in enumerate(values)}


def test_texts_that_are_no_json(spark):
    d = spark.createDataFrame([(1, "{"), (2, None), (3, "")], "i int, t string")
    assert {tuple(r.e) for r in d.select(S.schema_errors(F.col("t"), {"type": "object"}).alias("e")).collect()} == {("/: not readable as JSON",)}
    good, bad = S.gate(spark.createDataFrame([(1, "{}", "c"), (2, '{"a":1,"b":2}', "c")], "i int, t string, v string"), "t", {"properties": {"a": False, "b": False}}, shown=1)
    assert [tuple(r) for r in good.collect()] == [(1, "{}", "c")] and [(r.i, r.errors) for r in bad.collect()] == [(2, ["/a: not allowed"])]


def test_catalogue(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "item.json").write_text(json.dumps(ITEM, indent=1))
    assert S.read_catalogue(spark, str(tmp_path)) == {"urn:item": ITEM}
    for docs in ([{}], [ITEM, ITEM]):
        with pytest.raises(ValueError):
            S.catalogue(docs)
    with pytest.raises(KeyError):
        S.schema_errors(F.lit("1"), {"$ref": "urn:none"})
    with pytest.raises(ValueError):
        S.schema_errors(F.lit("1"), {"properties": {"a": {"$ref": "#"}}})


def test_rfc3339(spark):
    d = spark.createDataFrame([("2026-07-01T10:00:00+02:00", "2026-07-01 08:00:00"), ("2026-07-01t10:00:00.5z", "2026-07-01 10:00:00.5"), ("2026-07-01 10:00:00Z", "2026-07-01 10:00:00"), ("2026-07-01T10:00:00", None), ("2026-02-30T10:00:00Z", None), ("2026-07-01", None), ("x", None), (None, None)], "t string, w string")
    assert all(r.g == r.w for r in d.select(S.rfc3339(F.col("t")).cast("string").alias("g"), "w").collect())
