"""One collection: landed payloads to snapshots, deltas, events, dispatch, exceptions and a report, as tables of one run.

What a run does is a list of tasks; everything else are the operators of this package. No step loops over rows or sources:
the tasks of one normalizer are normalised together, those of one kind are compared together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronodiff.operators import corroborate, diff, events
from chronodiff.operators.joins import bounded
from chronodiff.session import settled
from chronodiff.sources import normalize, pages, registry

#: The kind of snapshot that each normalizer makes.
KIND_OF = {"models": "models-api", "token-prices": "pricing-api", "price-list": "pricing-api", "retail-prices": "pricing-api", "status-json": "statuspage", "status-atom": "statuspage", "status-rss": "statuspage", "service-events": "statuspage", "status-graph": "statuspage", "page": "docs-html"}
#: What orders and identifies the rows of a snapshot, of each kind.
KEYS_OF = {"models-api": ["source_id", "id"], "pricing-api": ["source_id", "model_ref", "direction", "tier", "region"], "statuspage": ["source_id", "id"], "docs-html": ["source_id", "field_path"]}


@dataclass(frozen=True)
class Task:
    """One source of a collector. ``provider``: of all its changes, else that of the model; ``options`` are the normalizer's."""

    collector: str
    source_id: str
    normalizer: str
    namespace: str | None = None
    provider: str | None = None
    options: tuple = ()


def catalogue(spark: SparkSession, tasks: list[Task]) -> DataFrame:
    """(collector, source_id, normalizer, kind, namespace, provider) of the tasks; a source that two tasks have, or an unknown normalizer, raises."""
    if len({t.source_id for t in tasks}) < len(tasks):
        raise ValueError("a source has two tasks")
    rows = [(t.collector, t.source_id, t.normalizer, KIND_OF[t.normalizer], t.namespace, t.provider) for t in tasks]
    return spark.createDataFrame(rows, "collector string, source_id string, normalizer string, kind string, namespace string, provider string")


def canonical_order(snapshot: DataFrame, kind: str) -> DataFrame:
    """A snapshot's rows in the order in which it is stored: by its keys, in binary order."""
    return snapshot.orderBy(*KEYS_OF[kind])


def delta_order(deltas: DataFrame) -> DataFrame:
    """Deltas in the order in which they are reported: by source, what was added, removed and modified, then by subject and field, in binary order."""
    rank = F.array_position(F.array(F.lit("added"), F.lit("removed"), F.lit("modified")), F.col("delta_kind"))
    return deltas.orderBy("source_id", rank, "subject", "field_path")


def _normalised(landed: DataFrame, tasks: list[Task]) -> DataFrame:
    name, options = tasks[0].normalizer, tasks[0].options
    mine = landed.where(F.col("source_id").isin([t.source_id for t in tasks]))
    if name == "page":
        rule = options[0] if options else pages.Rule()
        return pages.extract(mine, "source_id", "payload", rule).withColumn("extraction_rule_id", F.lit(rule.kind))
    return normalize.NORMALIZERS[name](mine, *options)


def snapshots(landed: DataFrame, tasks: list[Task]) -> dict[str, DataFrame]:
    """kind -> the canonical rows of all its sources. Landed: (source_id, payload), one row a source."""
    out: dict[str, list[DataFrame]] = {}
    groups: dict[tuple, list[Task]] = {}
    for t in tasks:
        groups.setdefault((t.normalizer, t.options), []).append(t)
    for (name, _), own in groups.items():
        out.setdefault(KIND_OF[name], []).append(_normalised(landed, own))
    return {k: reduce(lambda a, b: a.unionByName(b), parts) for k, parts in out.items()}


def compared(kind: str, prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Deltas of one kind of snapshot; sources that have no earlier run give none."""
    return diff.diff_docs(prev, cur, ["imports"]) if kind == "docs-html" else diff.DIFFERS[kind](prev, cur)


@dataclass(frozen=True)
class Builder:
    """How a delta of one type becomes an event: its key's values, and what is said of it."""

    old: Column
    new: Column
    summary: Column
    data: Column
    path: Column | None = None


def _said(template: str) -> Column:
    """A sentence whose `{column}` parts are columns; a null one is `none`."""
    parts = template.replace("}", "{").split("{")
    return F.concat(*[F.coalesce(F.col(p).cast("string"), F.lit("none")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def builders() -> dict[str, Callable[[], Builder]]:
    """One builder for each type of event that can be minted."""
    null, model, subject = F.lit(None).cast("string"), events.json_value(F.col("model")), events.json_value(F.col("subject"))
    old, new = events.json_value(F.col("old")), events.json_value(F.col("new"))
    data = lambda **c: F.to_json(F.struct(*[v.alias(k) for k, v in c.items()]), {"ignoreNullFields": "false"})
    lists = lambda c: F.from_json(c, "array<string>")
    pct = events.percent_change(F.col("old").try_cast("double"), F.col("new").try_cast("double"))
    absent = F.when(F.col("kind") == "docs-html", "docs").otherwise("api-absence")
    number = lambda c: F.col(c).try_cast("double")
    return {
        "model.released": lambda: Builder(null, model, _said("{subject} is listed for the first time by {source_id}."), data(observed_via=F.col("source_id"))),
        "model.deprecated": lambda: Builder(model, null, _said("{subject} is no longer listed by {source_id}; a listing that lacks it is no retirement."), data(source_kind=absent)),
        "limits.changed": lambda: Builder(old, new, _said("The context window of {subject} went from {old} to {new}, as {source_id} has it."), data(limit_kind=F.lit("context"), old=number("old"), new=number("new"))),
        "capability.changed": lambda: Builder(F.col("old"), F.col("new"), _said("The endpoints of {subject} went from {old} to {new}, as {source_id} has it."), data(capability=F.lit("endpoints"), old=lists(F.col("old")), new=lists(F.col("new")))),
        "price.changed": lambda: Builder(old, new, F.concat(_said("A price of {subject} went from {old} to {new} USD per million tokens ("), F.format_string("%+.4f", pct), F.lit("%).")), data(pct_change=pct, old=number("old"), new=number("new"))),
        "outage.started": lambda: Builder(null, subject, _said("Incident {subject} of {provider} began."), data(incident_id=F.col("subject"))),
        "outage.resolved": lambda: Builder(old, new, _said("Incident {subject} of {provider} went from {old} to {new}."), data(incident_id=F.col("subject")), F.concat(F.lit("incidents[id="), F.col("subject"), F.lit("].status"))),
    }


def built(deltas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations, exceptions) of resolved deltas (collector, kind, source_id, event_type, field_path, delta_kind, subject, old, new, model, provider, observed_at).

    Observations have their id, hashes, ``summary`` (at most 280 characters) and ``data`` (JSON). Exceptions have a ``reason``:
    unclassified, alias-unmapped or provider-unmapped. A type without a builder is unclassified.
    """
    known = builders()
    d = deltas.withColumn("event_type", F.when(F.col("event_type").isin(list(known)), F.col("event_type")))
    outage = F.coalesce(F.col("event_type").startswith("outage."), F.lit(False))
    d = d.withColumn("model", F.when(~outage, F.col("model")))

    def chosen(part: Callable[[Builder], Column | None], otherwise: Column) -> Column:
        c = F.when(F.lit(False), otherwise)
        for kind, make in known.items():
            if (x := part(make())) is not None:
                c = c.when(F.col("event_type") == kind, x)
        return c.otherwise(otherwise)

    null = F.lit(None).cast("string")
    d = d.withColumns({"old_json": chosen(lambda b: b.old, null), "new_json": chosen(lambda b: b.new, null), "summary": events.summary(chosen(lambda b: b.summary, null)), "data": chosen(lambda b: b.data, null), "key_path": chosen(lambda b: b.path, F.col("field_path"))})
    return events.identified(d.drop("field_path").withColumnRenamed("key_path", "field_path"))


def collect(landed: DataFrame, tasks: list[Task], previous: dict[str, DataFrame], aliases: DataFrame, providers: DataFrame, sources: DataFrame, stored: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a run: ``snapshot:<kind>``, deltas, events, actions with what they write (annotations, drafts, conflicts), exceptions, report.

    Landed: (source_id, run_ts, payload), the bytes' text of each source that answered, one row each; ``previous``: the last snapshot of
    each kind; ``aliases``: (namespace, alias, canonical_id); ``providers``: (namespace, prefix, provider), prefix `` for a whole
    namespace; ``stored``: open candidates as :func:`corroborate.dispatch` takes them. Events: one row an id, the evidence of all
    its sources united; actions: what became of each observation. The report has a row for each collector: how many sources it has,
    how many landed, deltas, events and exceptions, and its status: ok, partial or failed.
    """
    spark = landed.sparkSession
    plan = bounded(catalogue(spark, tasks))
    out: dict[str, DataFrame] = {}
    parts = []
    for kind, cur in snapshots(landed, tasks).items():
        out[f"snapshot:{kind}"] = cur = settled(cur)
        if kind in previous:
            parts.append(compared(kind, previous[kind], cur))
    deltas = reduce(lambda a, b: a.unionByName(b), parts) if parts else spark.createDataFrame([], ", ".join(f"{c} string" for c in diff.DELTA))
    at = landed.groupBy("source_id").agg(F.max("run_ts").alias("observed_at"))
    out["deltas"] = deltas = settled(deltas.join(plan.withColumnRenamed("provider", "fixed"), "source_id").join(bounded(at), "source_id"))
    resolved = registry.resolve_models(deltas, "subject", aliases, providers).withColumn("provider", F.coalesce("fixed", "provider"))
    good, bad = built(resolved.withColumnRenamed("canonical_id", "model"))
    good = settled(good)
    united = events.with_sources(good.withColumn("source_ids", F.array("source_id")).drop("source_id"), ["id", "observed_at"], "source_ids", ["collector", "subject"], sources)
    rest = ["event_type", "provider", "model", "subject", "field_path", "summary", "data"]
    first = F.min_by(F.struct("observed_at", *rest, "source_id"), F.struct("observed_at", "collector", "subject")).alias("_r")
    out["events"] = united.groupBy("id").agg(first, F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform("sources", lambda s: s.source_id))))).alias("source_ids")).select("id", "_r.*", "source_ids")
    out["actions"] = corroborate.dispatch(united.withColumn("absence", F.coalesce(F.get_json_object("data", "$.source_kind") == "api-absence", F.lit(False))), stored)
    out["actions"] = settled(out["actions"])
    written = corroborate.outcomes(out["actions"])
    out["annotations"], out["drafts"], out["conflicts"] = written["annotations"], written["drafts"], written["exceptions"]
    out["exceptions"] = bad.select("collector", "source_id", "reason", "field_path", "delta_kind", "subject", "old", "new", "observed_at")
    out["report"] = report(plan, landed, deltas, good, out["exceptions"])
    return out


def report(plan: DataFrame, landed: DataFrame, deltas: DataFrame, observed: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(collector, sources, landed, deltas, events, exceptions, status) of each collector; failed without any landed source."""
    n = lambda d, c, what: d.groupBy("collector").agg(what.alias(c))
    got = plan.join(landed.select("source_id", F.lit(1).alias("_l")).distinct(), "source_id", "left")
    d = n(got, "sources", F.count(F.lit(1))).join(n(got, "landed", F.count("_l")), "collector")
    for c, t, what in (("deltas", deltas, F.count(F.lit(1))), ("events", observed, F.count_distinct("id")), ("exceptions", exceptions, F.count(F.lit(1)))):
        d = d.join(n(t, c, what), "collector", "left")
    d = d.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("deltas", "events", "exceptions")})
    return d.withColumn("status", F.when(F.col("landed") == 0, "failed").when(F.col("landed") < F.col("sources"), "partial").otherwise("ok"))
