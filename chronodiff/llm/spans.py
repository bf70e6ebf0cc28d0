"""Long exact spans shared between records (problem 9).

Hashing of lines or paragraphs finds only spans that fill whole lines, and the spans sought start and end anywhere. So the
units are cut by content instead: a unit is a run of windows of the least length that have the same anchor (the
smallest hash in them). As with lines, the units' digests are grouped globally, the earliest ranked occurrence is
known, and the offsets are kept. Units of which only a part is shared, at the ends of a span, are compared with those of the
same anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronodiff.llm.fingerprints import Hashes, chunks, units
from chronodiff.operators.joins import bounded, skew_left_join
from chronodiff.session import settled

LENGTH = 200
GRAM = 100
#: Digests of one anchor that are compared in one place.
MOST = 1000


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def content_units(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, first, n, anchor, d1, d2): the units of each text; ``n`` windows of ``length`` characters from ``first`` on. One narrow pass."""
    names = ["doc_id", "first", "n", "anchor", "d1", "d2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for ks, offs, begin, text in chunks(keys, texts, length):
                p, f, n, a, d1, d2 = units(begin, text, length, gram)
                yield pa.RecordBatch.from_arrays([_i64(np.array(ks, np.int64)[p]), _i64(f + offs[p]), _i64(n), _i64(a), _i64(d1), _i64(d2)], names=names)

    long_enough = docs.where(F.char_length("text") >= length)
    return long_enough.select("doc_id", "text").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


UNIT = ["anchor", "d1", "d2", "low", "high", "n", "text"]


def _unit_texts(rows: DataFrame, length: int) -> DataFrame:
    """UNIT of each unit listed with a text: its keys, how many windows it has, and its own characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                # One text at a time: its units hold each character at most some times.
                columns = [[u[c] for u in parts] for c in UNIT[:-1]] + [[text[u["first"] : u["first"] + u["n"] + length - 1] for u in parts]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "text" else pa.int64()) for k, c in zip(UNIT, columns)], names=UNIT)

    return rows.mapInArrow(_merged(run), ", ".join(f"{c} {'string' if c == 'text' else 'bigint'}" for c in UNIT))


def _window_rows(units: dict[str, np.ndarray], texts: list[str], length: int) -> tuple[np.ndarray, ...]:
    """(unit, at, hash1, hash2) of every window of units, whose texts are laid end to end."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    h, n = Hashes(codes), units["n"]
    begin = np.cumsum(np.array([len(t) for t in texts])) - np.array([len(t) for t in texts])
    unit = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n)
    where = begin[unit] + at
    return unit, at, h.all_of(0, length)[where], h.all_of(1, length)[where]


def _stretches(units: dict[str, np.ndarray], texts: list[str], length: int) -> list[np.ndarray]:
    """(d1, d2, low, at, m): the stretches of windows of these units that also occur in a unit of another document; ``low`` the first document."""
    unit, at, w1, w2 = _window_rows(units, texts, length)
    order = np.lexsort((w2, w1))
    a, b = w1[order], w2[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    low = np.minimum.reduceat(units["low"][unit[order]], first)
    high = np.maximum.reduceat(units["high"][unit[order]], first)
    shared = (low != high)[group]
    hit, lows = order[shared], low[group][shared]
    back = np.argsort(hit)  # windows are numbered by unit and place
    hit, lows = hit[back], lows[back]
    if not len(hit):
        return [np.zeros(0, np.int64)] * 5
    cut = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (unit[hit[1:]] != unit[hit[:-1]]) | (lows[1:] != lows[:-1])])
    i = np.flatnonzero(cut)
    u = unit[hit[i]]
    return [units["d1"][u], units["d2"][u], lows[i], at[hit[i]], np.diff(np.append(i, len(hit)))]


def _compared(units: DataFrame, length: int) -> DataFrame:
    """:func:`_stretches` of units, anchor by anchor: rows are brought together and sorted by anchor, and a worker holds one batch and the anchor it ends in."""
    names = ["d1", "d2", "low", "at", "m"]

    def done(table: pa.Table) -> pa.RecordBatch:
        columns = {c: table.column(c).to_numpy() for c in UNIT[:-1]}
        return pa.RecordBatch.from_arrays([_i64(c) for c in _stretches(columns, table.column("text").to_pylist(), length)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            anchors = t.column("anchor").to_numpy()
            whole = int(np.argmax(anchors == anchors[-1]))  # rows before the last anchor
            if whole:
                yield done(t.slice(0, whole))
            rest = t.slice(whole)
        if rest is not None:
            yield done(rest)

    sorted_ = units.repartition("anchor").sortWithinPartitions("anchor").select(*UNIT)
    return sorted_.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def _windows(units: DataFrame, length: int) -> DataFrame:
    """(w1, w2, d1, d2, at, low, high) of every window of units."""
    names = ["w1", "w2", "d1", "d2", "at", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                c = {k: b.column(i).to_numpy() for i, k in enumerate(UNIT[:-1])}
                unit, at, w1, w2 = _window_rows(c, b.column(len(UNIT) - 1).to_pylist(), length)
                yield pa.RecordBatch.from_arrays([_i64(x) for x in (w1, w2, c["d1"][unit], c["d2"][unit], at, c["low"][unit], c["high"][unit])], names=names)

    return units.select(*UNIT).mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def _compared_by_window(units: DataFrame, length: int) -> DataFrame:
    """The rows of :func:`_compared`, for anchors of any number of units: a row for each window, which is combined by its hash before the shuffle."""
    w = _windows(units, length)
    hits = w.groupBy("w1", "w2").agg(F.min("low").alias("wl"), F.max("high").alias("wh")).where(F.col("wl") != F.col("wh"))
    some = skew_left_join(w, hits, ["w1", "w2"]).where(F.col("wl").isNotNull())
    # Consecutive windows of a unit become one stretch; a unit has at most length - gram + 1 windows that differ.
    by = W.partitionBy("d1", "d2", "wl").orderBy("at")
    some = some.withColumn("_g", F.col("at") - F.row_number().over(by))
    return some.groupBy("d1", "d2", F.col("wl").alias("low"), "_g").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("m")).drop("_g")


def _merged(run, rows: int = 50_000):
    """The batches of ``run``, joined to batches of about so many rows."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for b in run(batches):
            kept.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                kept, n = [], 0
        if kept:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

    return f


def shared_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(doc_id, start, stop, first_doc): stretches of each text of which every window also occurs in another document.

    A window is ``length`` consecutive characters, compared exactly. ``stop`` is exclusive; stretches of one document
    may overlap or touch. ``first_doc`` is the smallest doc_id that holds a window of the stretch. Null and shorter
    texts give no rows; of two documents with equal texts each holds the other's windows; a repetition inside one
    document doesn't count.

    Only digests are shuffled: one row a unit, about one in ``(length - gram) / 2`` characters, which is combined per
    digest before the shuffle, so that a passage in a third of all documents is one row a task. Of units that differ
    but have an anchor in common one representative of each digest is cut from its text and compared with the others
    of its anchor; an anchor with more than ``most`` digests isn't brought together, its windows are.
    """
    u = settled(content_units(docs, length, gram))
    # Most anchors occur in one document and are dropped before anything else shuffles.
    seen = u.groupBy("anchor").agg(F.min("doc_id").alias("_l"), F.max("doc_id").alias("_h"), F.count(F.lit(1)).alias("_n")).where(F.col("_l") != F.col("_h"))
    seen = settled(seen.select("anchor", "_n", F.lit(True).alias("_seen")))
    some = settled(skew_left_join(u, seen.drop("_n"), ["anchor"], counts=seen.select("anchor", "_n")).where(F.col("_seen")).drop("_seen"))
    digests = some.groupBy("anchor", "d1", "d2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min(F.struct("doc_id", "first", "n")).alias("rep"))
    known = settled(digests.join(digests.groupBy("anchor").agg(F.count(F.lit(1)).alias("_k")), "anchor"))
    whole = known.where("_k = 1").select("d1", "d2", "low", F.lit(0).cast("bigint").alias("at"), F.col("rep.n").cast("bigint").alias("m"))

    mixed = known.where(F.col("_k") > 1)
    listed = mixed.groupBy(F.col("rep.doc_id").alias("doc_id")).agg(F.collect_list(F.struct("anchor", "d1", "d2", "low", "high", F.col("rep.n").alias("n"), F.col("rep.first").alias("first"))).alias("parts"))
    texts = _unit_texts(docs.select("doc_id", "text").join(listed, "doc_id").select("text", "parts"), length)
    crowded = known.where(F.col("_k") > most).select("anchor").distinct()
    if crowded.isEmpty():
        compared = _compared(texts, length)
    else:
        texts, crowded = settled(texts), settled(crowded)
        compared = _compared(texts.join(crowded, "anchor", "left_anti"), length).unionByName(_compared_by_window(texts.join(bounded(crowded), "anchor", "left_semi"), length))
    d = skew_left_join(some.select("doc_id", "first", "d1", "d2"), whole.unionByName(compared).groupBy("d1", "d2").agg(F.collect_list(F.struct("low", "at", "m")).alias("_parts")), ["d1", "d2"])
    d = d.select("doc_id", "first", F.inline("_parts"))
    start = F.col("first") + F.col("at")
    return d.select("doc_id", start.alias("start"), (start + F.col("m") + (length - 1)).alias("stop"), F.col("low").alias("first_doc"))


def shared_chars(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, shared_chars): characters of each document that lie in a run of ``length`` or more that occurs in another one."""
    r = shared_runs(docs, length, gram).select("doc_id", "start", "stop")
    before = F.max("stop").over(W.partitionBy("doc_id").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1))
    r = r.withColumn("_b", F.coalesce(before, F.lit(0)))
    return r.groupBy("doc_id").agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "_b"))).cast("bigint").alias("shared_chars"))


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, start, stop): what would be removed when the earliest document with each window keeps it, with original offsets; merged."""
    r = shared_runs(docs, length, gram).where(F.col("first_doc") < F.col("doc_id"))
    order = W.partitionBy("doc_id").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1))
    r = r.withColumn("_new", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return r.groupBy("doc_id", "_g").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).select("doc_id", "start", "stop")
