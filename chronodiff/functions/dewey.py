"""Nodes of JSON texts with Dewey labels."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Nodes that are handed on at once.
BATCH = 20_000


def parse(text: str | None):
    """The JSON value of a text, or None. A byte order mark is dropped; text inside a JSON string is parsed again, however
    often it is wrapped: each wrapping is at least its two quotes shorter, so this ends.
    """
    while isinstance(text, str):
        try:
            text = json.loads(text.lstrip("\ufeff").strip())
        except (ValueError, RecursionError):
            return None
    return text


def _text(v) -> str | None:
    return v if isinstance(v, str) or v is None else json.dumps(v)


def walk(value, maps: frozenset[str]) -> Iterator[tuple[str, str, str | None, dict]]:
    """(label, path, key, fields) of each object or array, and of each scalar in an array, in document order.

    ``label``: ordinals from the root on, `1.3.2`; the parent's label is the label without its last ordinal. The root's
    is `1`. ``path``: the member names from the root on; an array's elements are `[]`, the members of an object whose
    path matches one of ``maps`` are `*`, as their names are data; the name itself is ``key``. ``fields``: the scalar
    members of an object, as text.
    """
    stack = [("1", "$", None, value)]
    while stack:
        label, path, key, v = stack.pop()
        below = []
        if isinstance(v, dict):
            star = path in maps
            fields = {k: _text(x) for k, x in v.items() if not isinstance(x, (dict, list))}
            yield label, path, key, fields
            for i, (k, x) in enumerate(v.items(), 1):
                if isinstance(x, (dict, list)):
                    below.append((f"{label}.{i}", f"{path}.*" if star else f"{path}.{k}", k, x))
        elif isinstance(v, list):
            yield label, path, key, {}
            for i, x in enumerate(v, 1):
                below.append((f"{label}.{i}", f"{path}[]", None, x))
        else:
            yield label, path, key, {"": _text(v)}
        stack.extend(reversed(below))


def nodes(df: DataFrame, key: str, body: str, maps: list[str]) -> DataFrame:
    """(key, label, path, name, fields) of all nodes of each readable body; an unreadable one gives no rows."""
    starred = frozenset(maps)
    kind = df.schema[key].dataType.simpleString()
    out = pa.schema([pa.field("k", pa.int64() if kind == "bigint" else pa.string()), pa.field("label", pa.string()), pa.field("path", pa.string()), pa.field("name", pa.string()), pa.field("fields", pa.map_(pa.string(), pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)
        for b in batches:
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                value = parse(text)
                if isinstance(value, (dict, list)):
                    for label, path, name, fields in walk(value, starred):
                        rows.append((k, label, path, name, list(fields.items())))
                        if len(rows) >= BATCH:
                            yield flush()
                            rows = []
        if rows:
            yield flush()

    d = df.select(key, body).mapInArrow(run, f"k {kind}, label string, path string, name string, fields map<string,string>")
    return d.withColumnRenamed("k", key)
