"""Problem 8: schedules, caps and shares."""

import os
import random
from collections import Counter, defaultdict

import pytest

from chronodiff.llm import mixing
from chronodiff.llm.encoding import TOKENIZERS
from chronodiff.plans.queries import read

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_schedules_stay_within_a_block():
    rng = random.Random(5)
    for blocks in [[1], [1, 1], [5, 1], [50, 1, 1, 1, 1], [7, 11, 13], *[[rng.randint(1, 200) for _ in range(rng.randint(2, 9))] for _ in range(40)]]:
        n, got = sum(blocks), [0] * len(blocks)
        plan = mixing.schedule(blocks)
        assert len(plan) == n and sorted(plan) == [(i, k) for i, b in enumerate(blocks) for k in range(b)]
        for t, (i, _) in enumerate(plan, 1):
            got[i] += 1
            assert all(abs(g * n - b * t) < n for g, b in zip(got, blocks))


def test_shares():
    assert mixing.shares([1, 1, 1], 10) == [4, 3, 3] and mixing.shares([0.5, 0.25, 0.25], 4) == [2, 1, 1] and sum(mixing.shares([0.1, 0.2, 0.33], 997)) == 997


TARGETS = [{"mix_id": "m", "source": "a", "weight": 3.0, "max_repeats": 2}, {"mix_id": "m", "source": "b", "weight": 1.0, "max_repeats": None}, {"mix_id": "m", "source": "none", "weight": 1.0, "max_repeats": 4}, {"mix_id": "z", "source": "a", "weight": 0.0, "max_repeats": 1}, {"mix_id": None, "source": "a", "weight": 1.0, "max_repeats": 1}]


def test_plan():
    rows, slots = mixing.plan(TARGETS, {"a": 3000, "b": 500}, block=100)
    by = {(r["mix_id"], r["source"]): r for r in rows}
    assert by["m", "a"]["quota"] == 6000 and by["m", "b"]["quota"] == 2000 and by["m", "none"]["quota"] == 0 and by["z", "a"]["quota"] == 0
    assert by["m", "a"]["target_share"] == pytest.approx(0.6) and Counter(s["source"] for s in slots) == {"a": 60, "b": 20}
    rows, _ = mixing.plan(TARGETS, {"a": 3000, "b": 500}, block=100, total=20_000)
    assert {r["source"]: r["quota"] for r in rows if r["mix_id"] == "m"} == {"a": 6000, "b": 5000, "none": 0}


def test_every_source_with_a_quota_has_its_blocks():
    few = [{"mix_id": "m", "source": s, "weight": w, "max_repeats": None} for s, w in (("a", 0.9), ("b", 0.05), ("c", 0.05))]
    rows, slots = mixing.plan(few, {"a": 9000, "b": 9000, "c": 9000}, total=6000)
    assert {r["source"]: (r["quota"], r["blocks"]) for r in rows} == {"a": (5400, 3), "b": (300, 1), "c": (300, 1)} and sorted(s["slot"] for s in slots) == list(range(5))
    large = [{"mix_id": "m", "source": s, "weight": w, "max_repeats": None} for s, w in (("a", 1.0), ("b", 0.3), ("c", 1e-5))]
    rows, slots = mixing.plan(large, {"a": 10**6, "b": 10**6, "c": 10**6}, block=10, total=10**6)
    blocks, got = {r["source"]: r["blocks"] for r in rows}, Counter()
    assert all(r["blocks"] == -(-r["quota"] // 10) > 0 for r in rows)
    n = sum(blocks.values())
    for t, s in enumerate(slots, 1):
        assert s["k"] == got[s["source"]]
        got[s["source"]] += 1
        assert all(abs(got[x] * n - b * t) < n for x, b in blocks.items())
    assert got == blocks and n > 10_000


@pytest.mark.skipif(not os.path.exists(TOKENIZERS), reason="no vocabulary files")
@pytest.mark.parametrize("block", [2048, 1])
def test_small_shares_keep_their_documents(spark, block):
    docs = spark.createDataFrame([(i, "a b c d e f", "abc"[i % 3]) for i in range(300)], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("m", "a", 0.9, None), ("m", "b", 0.05, None), ("m", "c", 0.05, None)], "mix_id string, source string, weight double, max_repeats bigint")
    plan, report = mixing.mix(docs, targets, block=block, total=30_000)
    got, want = Counter(r.source for r in plan.collect()), {r.source: r.docs for r in report.collect()}
    assert got == want == {"a": 4500, "b": 250, "c": 250}
    plan, report = mixing.mix(docs, targets, block=block, total=600)
    assert Counter(r.source for r in plan.collect()) == {r.source: r.docs for r in report.collect()} == {"a": 90, "b": 5, "c": 5}


@pytest.mark.skipif(not os.path.exists(TOKENIZERS), reason="no vocabulary files")
def test_whole_tables(spark):
    docs, targets = read(spark, SF, "documents"), read(spark, SF, "mix_targets")
    plan, report = mixing.mix(docs, targets, block=256)
    rows, caps = plan.collect(), {(r.mix_id, r.source): r.max_repeats for r in targets.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, tokens = Counter(), defaultdict(Counter)
    for r in rows:
        assert source[r.doc_id] == r.source
        taken[r.mix_id, r.source, r.doc_id] += 1
        tokens[r.mix_id][r.source] += r.n_tokens
    assert all(caps[m, s] is None or n <= caps[m, s] for (m, s, _), n in taken.items())
    longest = max(r.n_tokens for r in rows)
    for r in report.collect():
        assert r.tokens == tokens[r.mix_id][r.source] and r.max_repeats == caps[r.mix_id, r.source]
        total = sum(tokens[r.mix_id].values())
        assert r.actual_share == pytest.approx(r.tokens / total if total else 0)
    # Of the sources that have documents each is at its share but for one document at the end.
    for m, got in tokens.items():
        weights = {r.source: r.weight for r in targets.where(targets.mix_id == m).collect() if r.source in got}
        for s, n in got.items():
            assert abs(n - sum(got.values()) * weights[s] / sum(weights.values())) < 2 * longest + 256
    # Any beginning of the mix has the shares too.
    for m in tokens:
        seen, weights = Counter(), {r.source: tokens[m][r.source] for r in targets.where(targets.mix_id == m).collect()}
        mine = sorted((r.slot, r["pass"], r.begin, r.source, r.n_tokens) for r in rows if r.mix_id == m)
        for i, (slot, _, _, s, n) in enumerate(mine):
            seen[s] += n
            if i + 1 < len(mine) and mine[i + 1][0] != slot:
                for x, w in weights.items():
                    assert abs(seen[x] - sum(seen.values()) * w / sum(weights.values())) < 2 * (256 + longest) + 256


@pytest.mark.skipif(not os.path.exists(TOKENIZERS), reason="no vocabulary files")
def test_odd_documents(spark):
    docs = spark.createDataFrame([(1, "a b c", "a", 0), (2, "", "a", 0), (3, None, "a", 0), (4, "x y", "b", 0), (5, "z", None, 0)], "doc_id bigint, text string, source string, quota int")
    targets = spark.createDataFrame([("m", "a", 1.0, 2), ("m", "b", 1.0, None), ("e", "none", 1.0, 1), ("n", None, 1.0, 1)], "mix_id string, source string, weight double, max_repeats bigint")
    plan, report = mixing.mix(docs, targets)
    assert {(r.doc_id, r["pass"]) for r in plan.collect()} == {(1, 0), (1, 1), (4, 0), (4, 1), (4, 2)}
    assert {(r.mix_id, r.source, r.tokens, r.docs) for r in report.collect()} == {("m", "a", 6, 2), ("m", "b", 6, 3), ("e", "none", 0, 0)}
    plan, report = mixing.mix(docs.limit(0), targets)
    assert plan.count() == 0 and report.count() == 3
