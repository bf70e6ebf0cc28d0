"""JSON Schema as columns: a schema is compiled once to one expression over a parsed text, of any depth.

A text is parsed once to a variant; the checks stay in the JVM. Schemas refer to each other by ``$id`` in a catalogue, or to
their own ``#/...`` parts. Keywords: type, enum, const, pattern, format (date-time, date, uri), minLength, maxLength,
minimum, maximum, exclusiveMinimum, exclusiveMaximum, items, minItems, maxItems, uniqueItems, properties, required,
additionalProperties, minProperties, anyOf, oneOf, allOf, not, if/then/else, $ref. Any other keyword is an annotation.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most files of a catalogue, which is configuration.
CATALOGUE_FILES = 10_000
#: RFC 3339 with its zone, which is required.
DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"

Catalogue = dict[str, dict]


def catalogue(docs: list[dict]) -> Catalogue:
    """Schemas by their ``$id``; one without an id, or two with one id, raise."""
    out: Catalogue = {}
    for d in docs:
        if not d.get("$id"):
            raise ValueError("a schema without $id")
        if d["$id"] in out:
            raise ValueError(f"two schemas have the $id {d['$id']}")
        out[d["$id"]] = d
    return out


def read_catalogue(spark: SparkSession, folder: str) -> Catalogue:
    """The schemas in the JSON files of a folder at any depth."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").limit(CATALOGUE_FILES + 1).collect()
    if len(files) > CATALOGUE_FILES:
        raise ValueError(f"more than {CATALOGUE_FILES} schemas")
    return catalogue([json.loads(f.value) for f in files])


def rfc3339(text: Column) -> Column:
    """A text of RFC 3339 as a timestamp; null if it isn't one, has no zone, or isn't a day or time that exists."""
    t = F.when(text.rlike(DATE_TIME), F.upper(text))
    return F.try_to_timestamp(F.regexp_replace(t, "^(.{10}) ", "$1T"))


def _field(v: Column, name: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.variant_get(v, f"$['{quoted}']", "variant")


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _join(errors: list[Column]) -> Column:
    return F.flatten(F.array(*errors)) if errors else F.array().cast("array<string>")


class _Compiler:
    def __init__(self, schemas: Catalogue):
        self.schemas = schemas

    def resolved(self, ref: str, base: dict, way: tuple) -> tuple[dict, dict]:
        """(schema, its document) of a reference; a schema that holds itself can't be one expression and raises."""
        name, _, pointer = ref.partition("#")
        if name and name not in self.schemas:
            raise KeyError(f"unknown schema $id: {name}")
        doc = self.schemas[name] if name else base
        at = doc
        for part in pointer.split("/")[1:]:
            at = at[part.replace("~1", "/").replace("~0", "~")]
        if any(at is w for w in way):
            raise ValueError(f"schema refers to itself: {ref}")
        return at, doc

    def errors(self, v: Column, at: Column, schema, base: dict, way: tuple = ()) -> Column:
        """array<string> of ``pointer: message``; ``v`` is a variant that is there."""
        if schema is True:
            return _join([])
        if schema is False:
            return F.array(F.concat(at, F.lit(": not allowed")))
        way = (*way, schema)
        return _with(F.struct(v.alias("v"), F.schema_of_variant(v).alias("k")), lambda b: _join(list(self.rules(b["v"], b["k"], at, schema, base, way))))

    def fails(self, v: Column, schema, base: dict, way: tuple) -> Column:
        return F.size(self.errors(v, F.lit(""), schema, base, way)) > 0

    def rules(self, v: Column, kind: Column, at: Column, s: dict, base: dict, way: tuple):
        text, number = v.cast("string"), F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), v.cast("double"))
        is_text, is_list, is_object = kind == "STRING", kind.startswith("ARRAY"), kind.startswith("OBJECT")
        whole = kind.rlike(r"^BIGINT|^DECIMAL\(\d+,0\)") | F.coalesce(number == F.floor(number), F.lit(False))
        shapes = {"object": is_object, "array": is_list, "string": is_text, "integer": whole, "number": number.isNotNull(), "boolean": kind == "BOOLEAN", "null": kind == "VOID"}
        none = F.array().cast("array<string>")

        def say(wrong: Column, message: str | Column) -> Column:
            return F.when(wrong, F.array(F.concat(F.when(at == "", "/").otherwise(at), F.lit(": "), message if isinstance(message, Column) else F.lit(message)))).otherwise(none)

        def same(x) -> Column:
            if isinstance(x, bool):
                return (kind == "BOOLEAN") & (text == str(x).lower())
            if isinstance(x, (int, float)):
                return F.coalesce(number == float(x), F.lit(False))
            if isinstance(x, str):
                return is_text & (text == x)
            return kind == "VOID" if x is None else F.to_json(v) == json.dumps(x, separators=(",", ":"), sort_keys=True, ensure_ascii=False)

        def any_of(cs: list[Column]) -> Column:
            out = F.lit(False)
            for c in cs:
                out = out | c
            return out

        if "$ref" in s:
            to, doc = self.resolved(s["$ref"], base, way)
            yield self.errors(v, at, to, doc, way)
        if "type" in s:
            kinds = [s["type"]] if isinstance(s["type"], str) else s["type"]
            yield say(~any_of([shapes[k] for k in kinds]), f"not of type {' or '.join(kinds)}")
        if "enum" in s:
            yield say(~any_of([same(x) for x in s["enum"]]), "not one of the values")
        if "const" in s:
            yield say(~same(s["const"]), "not the value")
        if "pattern" in s:
            yield say(is_text & ~text.rlike(s["pattern"]), "does not match the pattern")
        if "format" in s:
            wrong = {"date-time": rfc3339(text).isNull(), "date": F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text)).isNull(), "uri": ~text.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:[^\s]*$")}.get(s["format"])
            if wrong is not None:
                yield say(is_text & wrong, f"not a {s['format']}")
        length = F.char_length(text)
        for key, wrong in (("minLength", lambda n: length < n), ("maxLength", lambda n: length > n)):
            if key in s:
                yield say(is_text & wrong(s[key]), "too short" if key == "minLength" else "too long")
        for key, wrong in (("minimum", lambda n: number < n), ("exclusiveMinimum", lambda n: number <= n), ("maximum", lambda n: number > n), ("exclusiveMaximum", lambda n: number >= n)):
            if key in s:
                yield say(F.coalesce(wrong(float(s[key])), F.lit(False)), "too small" if "inimum" in key else "too great")
        items = F.when(is_list, v.cast("array<variant>"))
        for key, wrong in (("minItems", lambda n: F.size(items) < n), ("maxItems", lambda n: F.size(items) > n)):
            if key in s:
                yield say(is_list & wrong(s[key]), "too few items" if key == "minItems" else "too many items")
        if s.get("uniqueItems"):
            texts = F.transform(items, lambda x: F.to_json(x))
            yield say(is_list & (F.size(F.array_distinct(texts)) < F.size(texts)), "items are not unique")
        if "items" in s:
            each = F.transform(items, lambda x, i: self.errors(x, F.concat(at, F.lit("/"), i.cast("string")), s["items"], base, way))
            yield F.coalesce(F.flatten(each), none)
        names = F.when(is_object, F.map_keys(v.cast("map<string,variant>")))
        for r in s.get("required", []):
            yield say(is_object & _field(v, r).isNull(), f"{r} is missing")
        if "minProperties" in s:
            yield say(is_object & (F.size(names) < s["minProperties"]), "too few members")
        for name, sub in s.get("properties", {}).items():
            inner = F.when(is_object, _field(v, name))
            yield F.when(inner.isNotNull(), self.errors(inner, F.concat(at, F.lit("/" + name)), sub, base, way)).otherwise(none)
        more = s.get("additionalProperties", True)
        extra = F.array_sort(F.array_except(names, F.array(*[F.lit(k) for k in s.get("properties", {})]).cast("array<string>")))
        if more is False:
            yield say(is_object & (F.size(extra) > 0), F.concat(F.lit("unknown "), F.array_join(extra, ",")))
        elif isinstance(more, dict):
            members = F.when(is_object, v.cast("map<string,variant>"))
            yield F.coalesce(F.flatten(F.transform(extra, lambda k: self.errors(F.element_at(members, k), F.concat(at, F.lit("/"), k), more, base, way))), none)
        for sub in s.get("allOf", []):
            yield self.errors(v, at, sub, base, way)
        if "anyOf" in s:
            yield say(~any_of([~self.fails(v, x, base, way) for x in s["anyOf"]]), "fits none of the alternatives")
        if "oneOf" in s:
            fits = sum(((~self.fails(v, x, base, way)).cast("int") for x in s["oneOf"]), F.lit(0))
            yield say(fits != 1, "does not fit exactly one of the alternatives")
        if "not" in s:
            yield say(~self.fails(v, s["not"], base, way), "fits what it must not")
        if "if" in s:
            met = ~self.fails(v, s["if"], base, way)
            yield F.when(met, self.errors(v, at, s.get("then", True), base, way)).otherwise(self.errors(v, at, s.get("else", True), base, way))


def schema_errors(text: Column, schema: dict, schemas: Catalogue | None = None) -> Column:
    """The sorted errors of a JSON text, ``pointer: message`` each, an empty array if it is valid; null and unreadable texts have one."""
    compiled = _with(F.try_parse_json(text), lambda v: F.when(v.isNull(), F.array(F.lit("/: not readable as JSON"))).otherwise(_Compiler(schemas or {}).errors(v, F.lit(""), schema, schema)))
    return F.array_sort(compiled)


def gate(rows: DataFrame, text: str, schema: dict, schemas: Catalogue | None = None, shown: int = 3) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with ``errors``, the first ``shown``): what may be written, and what is reported instead."""
    d = rows.withColumn("errors", schema_errors(F.col(text), schema, schemas))
    return d.where(F.size("errors") == 0).drop("errors"), d.where(F.size("errors") > 0).withColumn("errors", F.slice("errors", 1, shown))
