"""Token ids of every text of a corpus (problem 7)."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from chronodiff.llm.bpe import Encoder, read_ranks

#: Folder of the vocabulary files; the same on every machine.
TOKENIZERS = os.environ.get("CHRONODIFF_TOKENIZERS", "/opt/tokenizers")
#: Characters that are encoded at once.
BLOCK_CHARS = 1_000_000

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file; it is read once and its cache lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(read_ranks(path))
    return _encoders[path]


def blocks(texts: list[str], chars: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about so many characters in all; a longer text is a block of its own."""
    out, size = [], 0
    for t in texts:
        if out and size + len(t) > chars:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


def _encoded(enc: Encoder, column: pa.Array) -> pa.ListArray:
    values, offsets, base = [], [np.zeros(1, np.int64)], 0
    for part in blocks(pc.fill_null(column, "").to_pylist()):
        ids, ends = enc.encode_block(part, BLOCK_CHARS)
        values.append(np.array(ids, np.int32))
        offsets.append(ends[1:] + base)
        base += len(ids)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), pa.array(np.concatenate(values) if values else np.zeros(0, np.int32)))


def _begins(enc: Encoder, ids: pa.ListArray) -> pa.ListArray:
    """Where the bytes of each id begin in those of its text."""
    sizes = enc.bytes_of(ids.values.to_numpy())
    at = np.concatenate([[0], np.cumsum(sizes)])
    ends = ids.offsets.to_numpy()
    begins = at[:-1] - np.repeat(at[ends[:-1]], np.diff(ends))
    return pa.ListArray.from_arrays(ids.offsets, pa.array(begins.astype(np.int32)))


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS, offsets: bool = False) -> DataFrame:
    """(key, ids): the ids of each text, without special tokens; an empty list for an empty or null text. One narrow pass.

    With ``offsets`` also (offsets): where each id begins in the text's UTF-8 bytes; it ends where the next begins.
    """
    path = os.path.join(folder, f"{name}.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            ids = _encoded(enc, b.column(1))
            more = {"offsets": _begins(enc, ids)} if offsets else {}
            yield pa.RecordBatch.from_arrays([b.column(0), ids, *more.values()], names=["k", "ids", *more])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("k"), docs[text].alias("t")).mapInArrow(run, f"k {kind}, ids array<int>" + (", offsets array<int>" if offsets else "")).withColumnRenamed("k", key)


def sizes(docs: DataFrame, keys: list[str], text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(keys..., n_tokens) of each text; only the counts leave the workers."""
    path = os.path.join(folder, f"{name}.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            counts = []
            for part in blocks(pc.fill_null(b.column(b.num_columns - 1), "").to_pylist()):
                counts.append(np.diff(enc.encode_block(part, BLOCK_CHARS)[1]))
            n = pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*b.schema.names[:-1], "n_tokens"])

    fields = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, docs[text].alias("_text")).mapInArrow(run, f"{fields}, n_tokens bigint")
