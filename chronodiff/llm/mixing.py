"""Sources mixed to target weights (problem 8).

Method: Pfair scheduling. Each source is a stream of blocks of tokens; block k of a source of weight w is released at
k / w and due at (k + 1) / w; earliest deadline first picks the block of each slot, so that after any number of slots
each source is less than one block away from its share.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronodiff.llm.encoding import sizes
from chronodiff.operators.joins import BROADCAST_ROWS, bounded
from chronodiff.session import settled

#: Tokens of a block.
BLOCK = 2048
#: Slots that a worker hands on at once.
BATCH = 10_000
#: Most targets of all mixes together.
TARGETS = 100_000
#: Documents of one piece of a source's order.
PIECE = 20_000


def shares(weights: list[float], slots: int) -> list[int]:
    """Blocks of each source in ``slots`` slots: largest remainders, ties to the earlier one."""
    total = sum(map(Fraction, weights))
    exact = [Fraction(w) * slots / total for w in weights]
    out = [int(x) for x in exact]
    for i in sorted(range(len(weights)), key=lambda i: (out[i] - exact[i], i))[: slots - sum(out)]:
        out[i] += 1
    return out


def schedule(blocks: list[int]) -> list[tuple[int, int]]:
    """[(source, its block)] of each slot: earliest deadline first among the released blocks, ties to the earlier source."""
    return list(turns(blocks))


def turns(blocks: list[int]) -> Iterator[tuple[int, int]]:
    """:func:`schedule` one slot at a time; one block of each source is kept in memory."""
    n = sum(blocks)
    release = lambda i, k: k * n // blocks[i]
    due = lambda i, k: -(-(k + 1) * n // blocks[i])
    waiting = [(0, i, 0) for i, b in enumerate(blocks) if b]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    for slot in range(n):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due(i, k), i, k))
        _, i, k = heapq.heappop(ready)
        yield i, k
        if k + 1 < blocks[i]:
            heapq.heappush(waiting, (release(i, k + 1), i, k + 1))


def plan(targets: list[dict], available: dict[str, int], block: int = BLOCK, total: int | None = None) -> tuple[list[dict], Iterator[dict]]:
    """(one row per mix and source, one row per slot of each mix, made as they are taken), from the tokens each source has.

    A source has as many blocks as its quota begins, so each with a quota has one, and none is beyond the schedule.

    Without ``total`` a mix is as large as it can be with every source that has tokens exactly at its share, those
    without a cap repeated as often as that takes; if no source is capped each is taken once at most. With ``total`` a
    source beyond its cap gives what it has. A target with a null or nonpositive weight or without tokens gives
    nothing; equal targets of a mix count once (the greater weight, then the greater cap).
    """
    per_mix: dict[str, dict[str, tuple]] = {}
    for t in targets:
        if t["mix_id"] is None or t["source"] is None:
            continue
        w = float(t["weight"] or 0)
        w = w if 0 < w < float("inf") else 0.0
        cap = t["max_repeats"]
        new = (w, float("inf") if cap is None else float(max(cap, 0)))
        mix = per_mix.setdefault(t["mix_id"], {})
        mix[t["source"]] = max(mix.get(t["source"], new), new)
    rows = []
    for mix_id, sources in sorted(per_mix.items()):
        whole = sum(w for w, _ in sources.values())
        names = sorted(s for s, (w, cap) in sources.items() if w > 0 and cap > 0 and available.get(s, 0) > 0)
        weight = sum(sources[s][0] for s in names)
        limit = lambda s, none: available[s] * (none if sources[s][1] == float("inf") else sources[s][1])
        if names and total is None:
            capped = [s for s in names if sources[s][1] < float("inf")]
            size = min(limit(s, 1) * weight / sources[s][0] for s in capped or names)
        else:
            size = float(total or 0)
        quota = {s: int(min(size * sources[s][0] / weight, limit(s, float("inf")))) for s in names}
        given = {s: -(-q // block) for s, q in quota.items()}
        for s, (w, cap) in sorted(sources.items()):
            rows.append({"mix_id": mix_id, "source": s, "target_share": w / whole if whole else 0.0, "max_repeats": None if cap == float("inf") else int(cap), "available_tokens": available.get(s, 0),
                         "quota": quota.get(s, 0), "blocks": given.get(s, 0), "slots": sum(given.values())})
    slots = ({"mix_id": m, "source": names[i], "k": k, "slot": slot} for m, names, given in mixes(rows) for slot, (i, k) in enumerate(turns(given)))
    return rows, slots


def mixes(rows: list[dict]) -> list[tuple[str, list[str], list[int]]]:
    """(mix_id, sources, their blocks) of each mix in the rows of a plan."""
    out: dict[str, tuple[list[str], list[int]]] = {}
    for r in rows:
        if r["blocks"]:
            names, given = out.setdefault(r["mix_id"], ([], []))
            names.append(r["source"])
            given.append(r["blocks"])
    return [(m, *x) for m, x in out.items()]


def slots_of(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """(mix_id, source, _block, slot): the schedules of a plan, made by one task a mix that keeps one block of each source."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for m, names, given in zip(p["mix_id"], p["names"], p["given"]):
                each = enumerate(turns([int(b) for b in given]))
                while batch := [(m, names[i], k, slot) for slot, (i, k) in islice(each, BATCH)]:
                    yield pd.DataFrame(batch, columns=["mix_id", "source", "_block", "slot"])

    all_of = mixes(rows)
    d = spark.createDataFrame(all_of, "mix_id string, names array<string>, given array<bigint>").repartition(max(len(all_of), 1))
    out = d.mapInPandas(run, "mix_id string, source string, _block bigint, slot bigint")
    return F.broadcast(out) if sum(sum(given) for _, _, given in all_of) <= BROADCAST_ROWS else out


def ordered(docs: DataFrame, seed: int = 42, piece: int = PIECE) -> DataFrame:
    """(doc_id, source, n_tokens, begin, source_tokens): each source in a fixed random order with the tokens before each document.

    The order is that of a hash, cut into ranges of the hash of about ``piece`` documents, so that running sums are taken
    inside a range and over the list of ranges, never over a whole source in one task.
    """
    h = F.xxhash64("doc_id", F.lit(seed))
    count = docs.groupBy("source").agg(F.count(F.lit(1)).alias("_c"), F.sum("n_tokens").alias("source_tokens"))
    d = docs.withColumn("_h", h).join(bounded(count), "source")
    # The hash as a fraction of its whole range picks the range.
    d = d.withColumn("_r", F.floor((F.col("_h") / F.lit(2.0**64) + 0.5) * F.ceil(F.col("_c") / piece)))
    by = W.partitionBy("source", "_r").orderBy("_h", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    ranges = d.groupBy("source", "_r").agg(F.sum("n_tokens").alias("_t"))
    ranges = ranges.select("source", "_r", F.coalesce(F.sum("_t").over(W.partitionBy("source").orderBy("_r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    d = d.withColumn("_in", F.coalesce(F.sum("n_tokens").over(by), F.lit(0))).join(bounded(ranges), ["source", "_r"])
    return d.select("doc_id", "source", "n_tokens", (F.col("_b") + F.col("_in")).alias("begin"), "source_tokens")


def mix(docs: DataFrame, targets: DataFrame, block: int = BLOCK, total: int | None = None, **tokenizer) -> tuple[DataFrame, DataFrame]:
    """(plan, report).

    Plan: (mix_id, slot, source, doc_id, pass, n_tokens), a row for each time a document is taken; documents are whole,
    in the slot in which their first token falls, and in a slot ordered by pass and ``begin``. A document without
    tokens is never taken. Report: (mix_id, source, target_share, actual_share, tokens, docs, most_repeats,
    max_repeats, available_tokens), a row for each target.

    Collected are the targets (at most TARGETS, else this raises) and one number per source of a target. The schedule is made on the workers, a row
    for each block; it is broadcast if it is short, else documents taken and schedule shuffle to each other. Documents
    shuffle once into their order.
    """
    wanted = bounded(targets.where(F.col("source").isNotNull()).select("source").distinct())
    asked = targets.select("mix_id", "source", "weight", "max_repeats").limit(TARGETS + 1).collect()
    if len(asked) > TARGETS:
        raise ValueError(f"more than {TARGETS} targets")
    # Counted once: the order of the documents and the sums read it.
    n = settled(sizes(docs.join(wanted, "source", "left_semi"), ["doc_id", "source"], **tokenizer).where(F.col("n_tokens") > 0))
    have = {r.source: r.t for r in n.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    rows, _ = plan([r.asDict() for r in asked], have, block, total)
    spark = docs.sparkSession
    wants = spark.createDataFrame([tuple(r.values()) for r in rows], "mix_id string, source string, target_share double, max_repeats bigint, available_tokens bigint, quota bigint, blocks bigint, slots bigint")

    d = ordered(n).join(bounded(wants.where("quota > 0").select("mix_id", "source", "quota")), "source")
    # Passes over the source until the quota; the document in which it falls is taken whole if that stays within the cap.
    passes = F.ceil((F.col("quota") - F.col("begin")) / F.col("source_tokens"))
    d = d.withColumn("_n", passes).where("_n > 0").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
    d = d.withColumn("_block", F.expr(f"(pass * source_tokens + begin) div {int(block)}"))
    taken = d.join(slots_of(spark, rows), ["mix_id", "source", "_block"]).select("mix_id", "slot", "source", "doc_id", "pass", "n_tokens", "begin")

    got = d.groupBy("mix_id", "source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"), (F.max("pass") + 1).alias("most_repeats"))
    all_of = W.partitionBy("mix_id")
    report = wants.join(got, ["mix_id", "source"], "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    report = report.select("mix_id", "source", "target_share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(all_of), F.lit(0)), F.lit(0.0)).alias("actual_share"), "tokens",
                           F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), "max_repeats", "available_tokens")
    return taken, report
