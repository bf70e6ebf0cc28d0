"""Observed changes against the open ones of their key: minted, attached, damped or in conflict.

What becomes of a change depends on what became of earlier ones, so the changes of one key are taken in order of time; keys
are independent. The same step runs in batch and in a stream. A candidate is open for 72 hours after it was minted, and
only open candidates are kept in memory.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronodiff.operators.asof import as_of
from chronodiff.operators.events import ATTACH_HOURS, DAMP_HOURS, DAMP_STATUS_HOURS
from chronodiff.session import settled

HOUR = 3_600_000_000
GROUP = ["provider", "model", "field_path", "family"]
IN = ["id", "event_type", "old", "new", "hash8", "inverse8", "at", "source_id", "sources", "absence", *GROUP]
OUT = "id string, action string, candidate string, source_id string, at bigint"
AVAILABILITY = ["model.released", "model.deprecated", "model.retired"]
#: Classes of sources whose statement confirms that something is gone.
POSITIVE = ("provider-docs", "own-probe")


@dataclass
class Open:
    """A minted change that is still open."""

    id: str
    event_type: str
    at: int
    old: str | None
    new: str | None
    hash8: str
    absence: bool
    sources: dict[str, tuple] = field(default_factory=dict)
    flapped: bool = False


def independent(a: tuple, b: tuple) -> bool:
    return bool(a[0] and b[0] and a[0] != b[0] and a[1] != b[1])


def step(opened: list[Open], c: dict) -> tuple[str, str | None]:
    """(action, candidate id) of one change; ``opened`` is brought up to date."""
    opened[:] = [o for o in opened if c["at"] - o.at < ATTACH_HOURS * HOUR]
    seen = [o for o in opened if o.at <= c["at"]]
    last = lambda ok: next((o for o in reversed(seen) if ok(o)), None)

    def note(o: Open) -> None:
        for s, *who in c["sources"]:
            if s is not None:
                o.sources.setdefault(s, tuple(who))

    def attach(o: Open) -> tuple[str, str]:
        known = list(o.sources.values())
        novel = [who for s, *who in c["sources"] if s not in o.sources]
        note(o)
        if o.flapped:
            return "flap", o.id
        if not novel:
            return "already", o.id
        good = any(independent(who, k) for who in novel for k in known if not o.absence or who[0] in POSITIVE)
        return ("corroborated" if good else "mirror"), o.id

    if o := last(lambda o: o.hash8 == c["hash8"]):
        return attach(o)
    if o := last(lambda o: o.hash8 == c["inverse8"]):
        hours = DAMP_STATUS_HOURS if o.event_type.startswith(("outage.", "degradation.")) else DAMP_HOURS
        if c["at"] - o.at < hours * HOUR:
            action, o.flapped = ("flap" if o.flapped else "rollback"), True
            note(o)
            return action, o.id
    if o := last(lambda o: o.event_type == c["event_type"]):
        if c["old"] != o.new:
            if c["new"] == o.new:
                return attach(o)
            note(o)
            return "discrepancy", o.id
    new = Open(c["id"], c["event_type"], c["at"], c["old"], c["new"], c["hash8"], bool(c["absence"]))
    note(new)
    opened.append(new)
    opened.sort(key=lambda o: o.at)
    return "mint", None


def family(event_type: Column) -> Column:
    """Types that undo each other share a key; any other type is its own."""
    return F.when(event_type.isin(AVAILABILITY), "availability").otherwise(event_type)


def rows_in(changes: DataFrame, *more: str) -> DataFrame:
    """Changes (event columns, observed_at, source_id, absence) in the columns that the step takes.

    ``sources`` are all sources of a change, structs of source_id, source_class and lineage; without that column its one
    source is that of the columns of these names. A source without id is never known, so it is new each time.
    """
    each = F.col("sources") if "sources" in changes.columns else F.array(F.struct("source_id", "source_class", "lineage"))
    lists = F.transform(each, lambda s: F.array(s["source_id"], s["source_class"], s["lineage"]))
    d = changes.withColumn("sources", F.to_json(lists, {"ignoreNullFields": "false"})).withColumn("family", family(F.col("event_type"))).withColumn("at", F.unix_micros("observed_at"))
    return d.select(*IN, *more)


def clean(record: dict) -> dict:
    r = {k: None if v is None or v != v else v for k, v in record.items()}
    return {**r, "sources": json.loads(r["sources"] or "[]")}


def pieces(rows: DataFrame, hours: int = ATTACH_HOURS) -> DataFrame:
    """Rows (GROUP, at) with ``_piece``: the time of the last row of their key, up to theirs, that none of its rows precedes by less than ``hours``."""
    before = as_of(rows, rows.select(*GROUP, "at"), GROUP, F.col("at"), F.col("at"), {"_before": (F.max, F.col("at"))}, inclusive=False, null_safe=True)
    starts = before.where(F.col("_before").isNull() | (F.col("at") - F.col("_before") >= hours * HOUR)).select(*GROUP, "at").distinct()
    return as_of(rows, starts, GROUP, F.col("at"), F.col("at"), {"_piece": (F.max, F.col("at"))}, null_safe=True)


def dispatch(changes: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """(id, action, candidate, source_id, at) of each change. ``stored``: open candidates of earlier runs, in the same columns; they give no rows.

    A key is cut wherever nothing can be open any more, i.e. none of its changes lie in the 72 hours before; the pieces are
    independent, so a key with a third of all changes is spread over them. Pieces are brought together and sorted, with
    spilling; a worker keeps the open candidates of one piece at a time.
    """
    d = rows_in(changes).withColumn("_old", F.lit(False))
    if stored is not None:
        d = d.unionByName(rows_in(stored).withColumn("_old", F.lit(True)))
    d = pieces(settled(d))
    key = [*GROUP, "_piece"]
    d = d.repartition(*key).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in key], "at", F.col("_old").desc(), "id", "source_id")

    key_names = tuple(key)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, opened = None, []
        for p in parts:
            out = []
            for r in map(clean, p.to_dict("records")):
                k = tuple(r[c] for c in key_names)
                if k != key:
                    key, opened = k, []
                action, candidate = step(opened, r)
                if not r["_old"]:
                    out.append((r["id"], action, candidate, r["source_id"], r["at"]))
            yield pd.DataFrame(out, columns=["id", "action", "candidate", "source_id", "at"])

    return d.mapInPandas(run, OUT)


# What an action writes to its candidate's chain.
ANNOTATED = {"corroborated": "corroboration", "mirror": "mirror-corroborated", "rollback": "rollback", "flap": "flap", "discrepancy": "discrepancy"}


def outcomes(actions: DataFrame) -> dict[str, DataFrame]:
    """What a dispatch writes: ``annotations`` (event_id, kind, at, by, source_id) for a candidate's chain, ``drafts`` (event_id, by) of
    candidates that an independent source confirmed, and ``exceptions`` (event_id, reason, by) of values that contradict each other.

    A mint writes its event and an action `already` nothing. Each row is there once, however often it was observed.
    """
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in ANNOTATED.items() for x in kv]), F.col("action"))
    a = actions.withColumn("kind", kind).where(F.col("kind").isNotNull() & F.col("candidate").isNotNull())
    notes = a.select(F.col("candidate").alias("event_id"), "kind", "at", F.col("id").alias("by"), "source_id").distinct()
    drafts = notes.where("kind = 'corroboration'").select("event_id", "by").distinct()
    conflicts = notes.where("kind = 'discrepancy'").select("event_id", F.lit("value-conflict").alias("reason"), "by").distinct()
    return {"annotations": notes, "drafts": drafts, "exceptions": conflicts}


def dump(opened: list[Open]) -> str:
    return json.dumps([asdict(o) for o in opened])


def load(text: str) -> list[Open]:
    return [Open(**{**o, "sources": {k: tuple(v) for k, v in o["sources"].items()}}) for o in json.loads(text)]
