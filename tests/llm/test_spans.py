"""Problem 9 against a version that looks at every window."""

import os
import random

import numpy as np

from chronodiff.llm import fingerprints, spans
from chronodiff.llm.queries import QUERIES
from chronodiff.plans.queries import read

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute(docs, length):
    """(doc -> shared characters, doc -> characters that an earlier document has too)"""
    first, twice = {}, set()
    for i, t in sorted((i, t) for i, t in docs if t):
        for a in range(len(t) - length + 1):
            o = first.setdefault(t[a : a + length], i)
            if o != i:
                twice.add(t[a : a + length])
    shared, removed = {}, {}
    for i, t in docs:
        s, r = set(), set()
        for a in range(len(t or "") - length + 1):
            w = t[a : a + length]
            if w in twice:
                s |= set(range(a, a + length))
                if first[w] != i:
                    r |= set(range(a, a + length))
        if s:
            shared[i] = len(s)
        if r:
            removed[i] = r
    return shared, removed


def table(spark, docs):
    return spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id bigint, text string, anchor string")


def check(spark, docs, length, gram):
    d = table(spark, docs)
    # Anchors with many digests are compared by their windows: the same stretches.
    few = {tuple(r) for r in spans.shared_runs(d, length, gram).collect()}
    assert {tuple(r) for r in spans.shared_runs(d, length, gram, most=2).collect()} == few
    shared, removed = brute(docs, length)
    assert {r.doc_id: r.shared_chars for r in spans.shared_chars(d, length, gram).collect()} == shared
    out = {}
    for r in spans.repeated_runs(d, length, gram).collect():
        s = set(range(r.start, r.stop))
        assert not out.get(r.doc_id, set()) & s
        out[r.doc_id] = out.get(r.doc_id, set()) | s
    assert out == removed


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF, "documents").select("doc_id", "text").collect()]
    shared, _ = brute(docs, spans.LENGTH)
    assert shared and {r.doc_id: r.shared_chars for r in QUERIES["p9_found"](spark, SF).collect()} == shared


def test_odd_texts(spark):
    p = "abcdefghijklmnopqrstuvwxyz0123456789"
    docs = [(1, p), (2, "xx" + p[3:30] + "yy" + p[10:36]), (3, None), (4, ""), (5, "short"), (6, "a" * 100), (7, "b" + "a" * 40), (8, "q" * 50 + "r" + "q" * 50), (9, p[:12] + "🚀" + p[12:]), (10, p), (11, "中" * 30), (12, "x中" * 2 + "中" * 25)]
    check(spark, docs, 12, 6)
    assert spans.shared_chars(table(spark, []), 12, 6).count() == 0


def test_random_texts(spark):
    rng = random.Random(11)
    pieces = ["".join(rng.choice("abc ") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    docs = [(i, "".join(rng.choice(pieces) if rng.random() < 0.6 else "".join(rng.choice("abc ") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    check(spark, docs, 20, 10)


def test_units_hold_each_window_once_whatever_surrounds_it(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(3000))
    whole = {}
    for size in (10_000, 137):
        seen = {}
        for _, offs, begin, t in fingerprints.chunks([0], [text], 50, size):
            p, f, n, a, _, _ = fingerprints.units(begin, t, 50, 20)
            for q, x, m, y in zip(p, f, n, a):
                for w in range(x + offs[q], x + offs[q] + m):
                    assert w not in seen
                    seen[w] = y
        assert sorted(seen) == list(range(len(text) - 49))
        whole[size] = seen
    assert whole[10_000] == whole[137]


def test_hashes_depend_on_the_characters_alone():
    a = np.frombuffer("hello world hello".encode("utf-32-le"), np.uint32)
    h = fingerprints.Hashes(a)
    for w in range(2):
        g = h.all_of(w, 5)
        assert g[0] == g[12] == h.of(w, np.array([12]), 5)[0] and len(set(g.tolist())) == len(g) - 1
