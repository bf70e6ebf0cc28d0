"""Problem 7 against the public libraries, and round trips."""

import os
import random

import numpy as np
import pytest

from chronodiff.llm import bpe, encoding
from chronodiff.llm.queries import QUERIES
from chronodiff.plans.queries import read

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATH = f"{encoding.TOKENIZERS}/byte_bpe_50k.tiktoken"
tokenizers = pytest.importorskip("tokenizers")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")


@pytest.fixture(scope="module")
def public():
    t = tokenizers.Tokenizer.from_file(f"{encoding.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def own():
    enc = bpe.Encoder(bpe.read_ranks(PATH))

    def f(texts):
        ids, ends = enc.encode(texts)
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    return f


ODD = ["", " ", "\n", "a", "'", "''s", "'s's", " 's", "\t's", "\n 's", "don't", "'rest", "x'llamas", "  two  spaces  ", "\n\n a", "a\r\n b", "<|endoftext|>", "12 345", "é中🚀", "​a", "\x85a", "　　b", "a" * 20_000, "'" * 999, " " * 5000 + "x", "中" * 3000, "9" * 5000]


def test_odd_texts(own, public):
    assert own(ODD) == public(ODD)
    assert own([]) == [] and own(["", ""]) == [[], []]


def test_random_texts(own, public):
    rng = random.Random(7)
    alphabet = " \n\t'srtvelmdS.,!a1é中  　²Ⅷ٣🚀​\x85\x1c"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x3000), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(2000)]
    assert own(texts) == public(texts)


def test_long_texts_in_parts(public):
    enc = bpe.Encoder(bpe.read_ranks(PATH))
    rng = random.Random(9)
    texts = ["".join(rng.choice(" \n'srtvelmd.1é") for _ in range(3000)), "a" * 700 + " b" * 700, " " * 500, "x" + "'" * 900 + "ll", "word " * 300 + "\n" * 200 + "end"]
    for t in texts:
        for size in (5, 17, 64):
            assert "".join(bpe.parts(t, size)) == t
            ids, ends = enc.encode_block([t], size)
            assert ids == public([t])[0] and ends.tolist() == [0, len(ids)]


def test_scan_is_the_automaton():
    rng = np.random.default_rng(3)
    for n in (1, 127, 128, 129, 5000):
        sym = rng.integers(0, 16, n).astype(np.uint8)
        state, want = 0, []
        for s in sym:
            want.append(state)
            state = bpe.NEXT[s, state]
        assert bpe.states_before(sym).tolist() == want


def test_round_trip(own):
    words = {i: b for b, i in bpe.read_ranks(PATH).items()}
    assert [bpe.decode(ids, words) for ids in own(ODD)] == ODD


def test_whole_table(spark, public):
    docs = {r.doc_id: r.text or "" for r in read(spark, SF, "documents").select("doc_id", "text").collect()}
    out = {r.doc_id: list(r.ids) for r in QUERIES["p7_ids"](spark, SF).collect()}
    assert out == dict(zip(docs, public(list(docs.values()))))


def test_offsets(spark, monkeypatch):
    words = {i: b for b, i in bpe.read_ranks(PATH).items()}
    texts = [None, "", "a b", "héllo  wörld 🚀🚀\n\n中文 12345", "it's   a test " * 40, "x" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    for r in encoding.encode(docs, offsets=True).collect():
        data = (texts[r.doc_id] or "").encode()
        ends = [*r.offsets[1:], len(data)] if r.ids else []
        assert len(r.ids) == len(r.offsets) and [data[a:b] for a, b in zip(r.offsets, ends)] == [words[i] for i in r.ids]
        assert (r.offsets[0] == 0) if data else (r.ids == r.offsets == [])


def test_null_and_empty(spark):
    d = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "a b", 7)], "doc_id bigint, text string, ids int")
    assert {r.doc_id: list(r.ids) for r in encoding.encode(d).collect()} == {1: [], 2: [], 3: [64, 275]}
    assert {(r.doc_id, r.n_tokens) for r in encoding.sizes(d, ["doc_id"]).collect()} == {(1, 0), (2, 0), (3, 2)}
    assert encoding.encode(d.limit(0)).count() == 0
