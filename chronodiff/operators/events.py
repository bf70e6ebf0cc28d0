"""Deltas to events: ids from content, evidence united, sources and time windows compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronodiff.functions import identity as I
from chronodiff.operators.asof import as_of
from chronodiff.operators.joins import bounded

#: Types that undo each other; any other type undoes itself.
REVERSALS = {"model.released": "model.deprecated", "model.deprecated": "model.released", "model.retired": "model.released"}
ATTACH_HOURS = 72
DAMP_HOURS, DAMP_STATUS_HOURS = 48, 24


def json_value(text: Column) -> Column:
    """A text as canonical JSON: a number stays a number, anything else is a JSON string, null is null."""
    number = text.rlike(r"^-?(0|[1-9]\d*)(\.\d*[1-9])?$")
    string = F.regexp_replace(F.to_json(F.array(F.trim(text))), r"^\[|\]$", "")
    return F.when(text.isNull(), None).when(number, text).otherwise(string)


def reversed_type(event_type: Column) -> Column:
    c = None
    for a, b in REVERSALS.items():
        c = F.when(event_type == a, b) if c is None else c.when(event_type == a, b)
    return c.otherwise(event_type)


def damping_hours(event_type: Column) -> Column:
    return F.when(event_type.rlike(r"^(outage|degradation)\."), DAMP_STATUS_HOURS).otherwise(DAMP_HOURS)


def identified(deltas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations, exceptions) of deltas (provider, model, event_type, field_path, old, new, observed_at, ...).

    A delta with a type, a provider and a model (or one that needs none, an outage) has an event id; the others are
    exceptions with a reason. Observations have ``id``, ``hash8``, ``inverse8`` (of the change that undoes it). The key's values
    are ``old`` and ``new`` as JSON, or ``old_json`` and ``new_json`` if there are such columns.
    """
    reason = F.when(F.col("event_type").isNull(), "unclassified").when(F.col("provider").isNull(), "provider-unmapped").when(F.col("model").isNull() & ~F.col("event_type").startswith("outage."), "alias-unmapped")
    d = deltas.withColumn("reason", reason)
    given = "old_json" in deltas.columns
    old, new = (F.col("old_json"), F.col("new_json")) if given else (json_value(F.col("old")), json_value(F.col("new")))
    key = I.key_text(F.col("provider"), F.col("model"), F.col("event_type"), F.col("field_path"), old, new)
    inverse = I.key_text(F.col("provider"), F.col("model"), reversed_type(F.col("event_type")), F.col("field_path"), new, old)
    good = d.where(F.col("reason").isNull()).drop("reason")
    good = good.withColumns({"id": I.event_id(key, F.col("observed_at")), "hash8": I.hash8(key), "inverse8": I.hash8(inverse)})
    return good, d.where(F.col("reason").isNotNull())


def mint(deltas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, exceptions) as of :func:`identified`, but one event per id: the first observed."""
    good, bad = identified(deltas)
    rest = [c for c in good.columns if c != "id"]
    # Ties at one instant: the smallest row as JSON text.
    one = good.groupBy("id").agg(F.min_by(F.struct(*rest), F.struct("observed_at", F.to_json(F.struct(*rest)))).alias("_r")).select("id", "_r.*")
    return one, bad


def summary(text: Column, most: int = 280) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit("…"))).otherwise(text)


def percent_change(old: Column, new: Column) -> Column:
    """Change in percent to 4 digits; 0 from a zero baseline."""
    return F.when(old == 0, F.lit(0.0)).otherwise(F.round((new - old) / old * 100, 4))


def united_evidence(items: DataFrame, key: str, identity: list[str], order: list[str]) -> DataFrame:
    """One row per key and identity: the first in ``order``. Evidence of one event from several tasks."""
    rest = [c for c in items.columns if c not in (key, *identity)]
    return items.groupBy(key, *identity).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, *identity, "_r.*")


def repeated_within(events: DataFrame, key: list[str], at: str, order: list[str], hours: int = ATTACH_HOURS) -> DataFrame:
    """Events less than ``hours`` after the one before of the same key, with ``before``: duplicates that should have been attached."""
    w = W.partitionBy(*key).orderBy(at, *order)
    d = events.withColumn("before", F.lag(at).over(w))
    gap = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.col("before").cast("timestamp"))
    return d.where(F.col("before").isNotNull() & (gap < hours * 3_600_000_000))


def latest_within(observed: DataFrame, candidates: DataFrame, keys: list[str], at: str, identity: str, hours: int = ATTACH_HOURS) -> DataFrame:
    """``observed`` with ``candidate``: the id of the last candidate of the same keys from 0 to below ``hours`` before it, itself excepted.

    Of candidates of one time the one with the greatest id counts; null keys are equal. Each candidate knows the one
    before it, which takes its place for the row that is the candidate itself. No pairs: rows are ordered in their key.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    c = candidates.select(*keys, micros(at).alias("_at"), F.col(identity).alias("_id")).where(F.col("_at").isNotNull() & F.col("_id").isNotNull())
    c = as_of(c, c, keys, F.col("_at"), F.col("_at"), {"_before": (F.max, F.struct("_at", "_id"))}, F.col("_id"), F.col("_id"), inclusive=False, null_safe=True)
    d = as_of(observed, c, keys, micros(at), F.col("_at"), {"_c": (F.max, F.struct("_at", "_id", "_before"))}, null_safe=True)
    found = F.when(F.col(identity).eqNullSafe(F.col("_c._id")), F.col("_c._before")).otherwise(F.struct(F.col("_c._at").alias("_at"), F.col("_c._id").alias("_id")))
    near = micros(at) - found["_at"] < hours * 3_600_000_000
    return d.withColumn("candidate", F.when(near, found["_id"])).drop("_c")


def first_own_manifest(evidence: Column, source: Column) -> Column:
    """The first manifest path that a source's own evidence cites; null if none does."""
    return F.get(F.filter(evidence, lambda e: (e["source_id"] == source) & e["manifest_path"].isNotNull()), F.lit(0))["manifest_path"]


def kinds_overlap(kinds: Column, of: list[str]) -> Column:
    """Whether an array of annotation kinds has any of some; null has none."""
    return F.coalesce(F.arrays_overlap(F.array_compact(kinds), F.array(*[F.lit(k) for k in of])), F.lit(False))


def lineage(source_class: Column, line: Column, mirror: Column) -> Column:
    """The lineage that independence compares: mirrors and docs share one, probes have their own, others that of their class."""
    docs = (line == "third-party-aggregator") | mirror | (source_class == "provider-docs")
    probe = (line == "own-probe") | (source_class == "own-probe")
    return F.when(F.coalesce(docs, F.lit(False)), "provider-docs").when(F.coalesce(probe, F.lit(False)), "own-probe").otherwise(F.coalesce(source_class, F.lit("unknown")))


def independent(a: Column, b: Column) -> Column:
    """Of structs (source_class, lineage): both known, of different class and of different lineage."""
    return F.coalesce(a.source_class.isNotNull() & b.source_class.isNotNull() & (a.source_class != b.source_class) & (a.lineage != b.lineage), F.lit(False))


def any_independent(new: Column, old: Column) -> Column:
    """Of arrays of such structs: some pair is independent. The arrays are an event's sources, a few each."""
    return F.exists(new, lambda n: F.exists(old, lambda o: independent(n, o)))


def with_traits(items: DataFrame, source: str, sources: DataFrame) -> DataFrame:
    """Items with ``trait``, null for an unknown source."""
    t = sources.select(F.col("source_id").alias(source), F.struct("source_class", lineage(F.col("source_class"), F.col("lineage"), F.lit(False)).alias("lineage")).alias("trait"))
    return items.join(bounded(t), source, "left")


def with_sources(items: DataFrame, key: list[str], ids: str, order: list[str], sources: DataFrame) -> DataFrame:
    """One row per ``key``, the first in ``order``, with the ``sources`` of all its rows: structs (source_id, source_class, lineage).

    ``ids`` is an array of source ids; each different one counts once, one that isn't listed has no class and lineage.
    ``source_id`` becomes the first of the first row.
    """
    each = with_traits(items.select("*", F.posexplode_outer(ids).alias("_pos", "source_id")).drop(ids), "source_id", sources)
    one = F.when(F.col("_pos").isNotNull(), F.struct("source_id", "trait.source_class", "trait.lineage"))
    rest = [c for c in each.columns if c not in (*key, "_pos", "trait")]
    g = each.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order, "_pos")).alias("_r"), F.sort_array(F.collect_set(one)).alias("sources"))
    return g.select(*key, "_r.*", "sources")
