"""Watching documents and crawling rules for change."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodiff.functions.identity import collapse, nfc
from chronodiff.functions.urls import host
from chronodiff.operators.diff import changed_keys, set_changes
from chronodiff.session import kept

STANCE = T.StructType([T.StructField("allowed", T.BooleanType()), T.StructField("rules", T.ArrayType(T.StringType())), T.StructField("crawl_delay", T.StringType()), T.StructField("signals", T.MapType(T.StringType(), T.StringType()))])


def rule_pattern(rule: str) -> re.Pattern:
    """A rule's path as a pattern: `*` stands for anything, `$` at the end for the end; all else is itself, from the beginning on."""
    body, anchored = (rule[:-1], "$") if rule.endswith("$") else (rule, "")
    return re.compile(".*".join(map(re.escape, body.split("*"))) + anchored, re.DOTALL)


def stance(text: str | None, agent: str, path: str, fetched: str = "ok") -> tuple:
    """(allowed, rules, crawl delay, signals) that a robots.txt holds for an agent.

    The groups count that name the agent's token (what stands before its `/`, in any case), else those for all. Of the rules that
    match the path the longest decides, of equally long ones the one that allows. No rule allows. A file that is
    ``absent`` allows all, one that is ``unreachable`` nothing; both have no rules.
    """
    if fetched != "ok":
        return fetched == "absent", [], None, {}
    token = agent.split("/", 1)[0].strip().lower()
    by_name: dict[str, list[tuple[str, str]]] = {}
    signals: dict[str, str] = {}
    names: list[str] = []
    naming = False
    for line in (text or "").splitlines():
        field, sep, value = (x.strip() for x in line.split("#", 1)[0].partition(":"))
        field = field.lower()
        if not sep:
            naming = naming and bool(field)
        elif field == "user-agent":
            names = [*(names if naming else []), value.lower()]
            by_name.setdefault(names[-1], [])
            naming = True
        else:
            naming = False
            for n in names:
                by_name[n].append((field, value))
            if field == "content-signal":
                signals |= {k.strip().lower(): x.strip().lower() for k, s, x in (p.partition("=") for p in value.split(",")) if s}
    lines = by_name.get(token, by_name.get("*", []))
    rules = [(f, v) for f, v in lines if f in ("allow", "disallow") and v]
    hits = [(len(v), f == "allow") for f, v in rules if rule_pattern(v).match(path)]
    return (max(hits)[1] if hits else True), sorted(f"{f} {v}" for f, v in rules), next((v for f, v in lines if f == "crawl-delay"), None), signals


def stances(robots: DataFrame, text: str, path: str, agent: str, status: str | None = None) -> DataFrame:
    """``robots`` with ``stance`` (a struct) of each row's text for its path; ``status``: the column of the answer's status, else each text was fetched."""

    @F.pandas_udf(STANCE)
    def run(t: pd.Series, p: pd.Series, f: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([stance(a, agent, b or "/", c) for a, b, c in zip(t, p, f)], columns=STANCE.names)

    return robots.withColumn("stance", run(F.col(text), F.col(path), F.lit("ok") if status is None else fetched_as(F.col(status))))


def fetched_as(status: Column) -> Column:
    """What an answer to a robots.txt request means: its text holds, there is none, or the host can't be reached."""
    return F.when(status.between(200, 299), "ok").when(status.between(400, 499) & (status != 429), "absent").otherwise("unreachable")


def stance_changes(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """(host, field, old, new) of stances that differ; rows (host, stance)."""
    flat = lambda d: d.select("host", F.explode(F.map_from_arrays(F.array(*[F.lit(f) for f in STANCE.names]), F.array(F.col("stance.allowed").cast("string"), F.to_json("stance.rules"), F.col("stance.crawl_delay"), F.to_json("stance.signals")))).alias("field", "value"))
    return changed_keys(flat(prev), flat(cur), ["host", "field"], "value")


def collection_blocking(prev: DataFrame, cur: DataFrame, host: str = "host", allowed: str = "allowed") -> DataFrame:
    """(host, blocking): whether a source of the host that was allowed no longer is. Rows (host, source_id, allowed)."""
    d = prev.select(host, "source_id", F.col(allowed).alias("_o")).join(cur.select(host, "source_id", F.col(allowed).alias("_n")), [host, "source_id"], "full_outer")
    return d.groupBy(host).agg(F.bool_or(F.coalesce("_o", F.lit(False)) & ~F.coalesce("_n", F.lit(False))).alias("blocking"))


def pins_missed(pins: DataFrame, seen: DataFrame, keys: list[str], want: str, have: str) -> DataFrame:
    """keys, want, have of pinned values that aren't observed as pinned."""
    d = pins.join(seen, keys, "left")
    return d.where(~F.col(want).eqNullSafe(F.col(have))).select(*keys, want, have)


def sentences_with(text: Column, *words: str) -> Column:
    """Sentences (split behind . ! ?) that hold all the words, in any case."""
    ok = lambda s: F.array_min(F.array(*[F.lower(s).contains(w.lower()).cast("int") for w in words])) == 1
    return F.filter(F.split(text, r"(?<=[.!?])\s+"), ok)


def quote_state(docs: DataFrame, text: str, quote: str, pinned: str | None) -> DataFrame:
    """``docs`` with ``digest`` and ``state``: quoted (the quote is there and the hash as pinned), changed, or lapsed."""
    plain = collapse(nfc(F.col(text)))
    d = docs.withColumn("_p", plain).withColumn("digest", F.sha2("_p", 256))
    same = F.lit(True) if pinned is None else F.col("digest") == pinned
    return d.withColumn("state", F.when(~F.col("_p").contains(" ".join(quote.split())), "lapsed").when(same, "quoted").otherwise("changed")).drop("_p")


# Severities and kinds of queue items.
SEVERITIES = ("notice", "warning", "critical")
STANCE_CHANGED, UNREACHABLE, SIGNALS_MISMATCH, STATE_SEEDED = "robots.stance-changed", "robots.unreachable", "robots.content-signals-mismatch", "robots.state-seeded"
REFERENCE_SEEDED, LAPSE, SET_SEEDED, DOCUMENTS_CHANGED, UNHANDLED, FAILED = "sentinel.reference-seeded", "sentinel.verdict-lapse", "sentinel.state-seeded", "sentinel.document-appeared", "sentinel.unhandled", "sentinel.failed"
ITEM = ["kind", "severity", "subject", "source_ids", "details", "queued_at"]


def items(rows: DataFrame, kind: str, severity: Column, subject: Column, source_ids: Column, details: Column, queued_at: Column) -> DataFrame:
    """Queue items (ITEM); ``details`` is JSON, a severity that isn't one of SEVERITIES raises."""
    known = F.when(severity.isin(*SEVERITIES), severity).otherwise(F.raise_error(F.concat(F.lit("unknown severity "), F.coalesce(severity, F.lit("null")))))
    return rows.select(F.lit(kind).alias("kind"), known.alias("severity"), subject.alias("subject"), F.coalesce(source_ids, F.array().cast("array<string>")).alias("source_ids"), details.alias("details"), queued_at.alias("queued_at"))


def recheck(hosts: DataFrame, answers: DataFrame, sources: DataFrame, previous: DataFrame, pins: DataFrame, agent: str, run_ts: Column) -> dict[str, DataFrame]:
    """One sweep over the hosts (host, source_ids): ``state``, ``items`` and ``report``.

    ``answers``: (host, http_status, body) of robots.txt; ``sources``: (source_id, url); ``previous``: (host, source_id, stance,
    fetched) of the last sweep; ``pins``: (source_id, signal, pinned). Items: a stance that changed (critical if a source of the host
    that was allowed no longer is), a host that can't be reached, signals that aren't as pinned, and hosts seen for the first time.
    """
    each = hosts.select("host", F.explode("source_ids").alias("source_id")).join(sources.select("source_id", "url"), "source_id").join(answers, "host", "left")
    path = F.concat(F.lit("/"), F.regexp_extract("url", r"^[A-Za-z]+://[^/]+/?(.*)$", 1))
    s = stances(each.withColumn("_path", path), "body", "_path", agent, "http_status")
    state = kept(s.select("host", "source_id", "stance", fetched_as(F.col("http_status")).alias("fetched"), "http_status"))
    one = lambda d: d.groupBy("host").agg(F.min_by("stance", "source_id").alias("stance"), F.min("fetched").alias("fetched"), F.array_sort(F.collect_set("source_id")).alias("source_ids"))
    now, before = one(state), one(previous)
    flat = lambda d: d.select("host", F.explode(F.map_from_arrays(F.array(*[F.lit(f) for f in ("fetched", "rules", "crawl_delay", "signals")]), F.array("fetched", F.to_json("stance.rules"), "stance.crawl_delay", F.to_json("stance.signals")))).alias("field", "value"))
    both = now.select("host").join(before.select("host"), "host")
    changed = changed_keys(flat(before), flat(now), ["host", "field"], "value").join(both, "host").select("host", "field", "old", "new")
    rights = lambda d: d.select("host", "source_id", F.col("stance.allowed").alias("allowed"))
    moved = changed_keys(rights(previous).withColumn("allowed", F.col("allowed").cast("string")), rights(state).withColumn("allowed", F.col("allowed").cast("string")), ["host", "source_id"], "allowed").join(both, "host")
    changed = changed.unionByName(moved.select("host", F.concat(F.lit("allowed:"), "source_id").alias("field"), "old", "new"))
    changed = changed.groupBy("host").agg(F.to_json(F.array_sort(F.collect_list(F.struct("field", "old", "new")))).alias("changes"))
    blocked = collection_blocking(rights(previous), rights(state))
    ids = now.select("host", "source_ids")
    a = items(changed.join(blocked, "host", "left").join(ids, "host"), STANCE_CHANGED, F.when(F.col("blocking"), "critical").otherwise("warning"), F.col("host"), F.col("source_ids"), F.col("changes"), run_ts)
    b = items(now.where("fetched = 'unreachable'"), UNREACHABLE, F.lit("warning"), F.col("host"), F.col("source_ids"), F.lit("{}"), run_ts)
    seen = state.where("fetched = 'ok'").select("host", "source_id", F.explode_outer("stance.signals").alias("signal", "observed"))
    missed = pins_missed(pins.join(state.select("host", "source_id"), "source_id"), seen.select("source_id", "signal", "observed"), ["source_id", "signal"], "pinned", "observed").join(state.select("host", "source_id"), "source_id")
    missed = missed.groupBy("host").agg(F.to_json(F.array_sort(F.collect_list(F.struct("source_id", "signal", "pinned", "observed")))).alias("_d"), F.array_sort(F.collect_set("source_id")).alias("_s"))
    c = items(missed, SIGNALS_MISMATCH, F.lit("critical"), F.col("host"), F.col("_s"), F.col("_d"), run_ts)
    new = now.join(before.select("host"), "host", "left_anti")
    d = items(new, STATE_SEEDED, F.lit("notice"), F.col("host"), F.col("source_ids"), F.lit("{}"), run_ts)
    report = now.select("host", "fetched").join(changed.select("host", F.lit(True).alias("changed")), "host", "left").join(new.select("host", F.lit(True).alias("seeded")), "host", "left")
    report = report.select("host", "fetched", F.coalesce("seeded", F.lit(False)).alias("seeded"), F.coalesce("changed", F.lit(False)).alias("changed"))
    return {"state": state, "items": a.unionByName(b).unionByName(c).unionByName(d), "report": report}


def selected(sentinels: DataFrame, ids: list[str] | None = None, cadence: str | None = None, everywhere: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """The sentinels (sentinel_id, cadence, ...) that run: those of ``ids``, of which each must exist, or those of a cadence, but for those that are checked ``everywhere`` and the excluded."""
    if ids:
        want = sentinels.sparkSession.createDataFrame([(i,) for i in ids], "sentinel_id string")
        d = want.join(sentinels.withColumn("_there", F.lit(True)), "sentinel_id", "left")
        return d.withColumn("sentinel_id", F.when(F.col("_there"), F.col("sentinel_id")).otherwise(F.raise_error(F.concat(F.lit("unknown sentinel "), "sentinel_id")))).drop("_there")
    if cadence is None:
        raise ValueError("name sentinels or a cadence")
    return sentinels.where((F.col("cadence") == cadence) & ~F.col("sentinel_id").isin([*everywhere, *exclude]))


def quote_sentinel(docs: DataFrame, references: DataFrame, locate: tuple[str, ...], run_ts: Column) -> dict[str, DataFrame]:
    """A pinned sentence and the hash of a whole text: ``state`` (the references, seeded where they were null) and ``items``.

    ``docs``: (sentinel_id, sentence_text, hashed_text; null: not modified); ``references``: (sentinel_id, quote, digest).
    A null quote is seeded with the first sentence that holds the words ``locate``, a null digest with the text's. What
    is pinned and isn't there any more, or can't be found, lapses.
    """
    d = docs.join(references, "sentinel_id", "left")
    text, whole = collapse(nfc(F.col("sentence_text"))), F.sha2(collapse(nfc(F.col("hashed_text"))), 256)
    hit = F.get(sentences_with(text, *locate), F.lit(0))
    d = d.withColumns({"_hit": hit, "_whole": whole, "_text": text, "_quote": collapse(nfc(F.col("quote")))})
    lost = F.when(F.col("_text").isNotNull() & F.col("quote").isNull() & F.col("_hit").isNull(), "sentence not found").when(F.col("_text").isNotNull() & F.col("quote").isNotNull() & ~F.col("_text").contains(F.col("_quote")), "sentence removed or modified")
    moved = F.when(F.col("digest").isNotNull() & F.col("_whole").isNotNull() & (F.col("digest") != F.col("_whole")), "text changed")
    d = d.withColumns({"reasons": F.array_compact(F.array(lost, moved)), "seeded": F.array_compact(F.array(F.when(F.col("quote").isNull() & F.col("_hit").isNotNull(), "quote"), F.when(F.col("digest").isNull() & F.col("_whole").isNotNull(), "digest")))})
    state = d.select("sentinel_id", F.coalesce("quote", "_hit").alias("quote"), F.coalesce("digest", "_whole").alias("digest"), F.when(F.size("reasons") > 0, "triggered").when(F.size("seeded") > 0, "seeded").otherwise("ok").alias("status"))
    none = F.lit(None).cast("array<string>")
    a = items(d.where(F.size("seeded") > 0), REFERENCE_SEEDED, F.lit("notice"), F.col("sentinel_id"), none, F.to_json(F.struct("seeded")), run_ts)
    b = items(d.where(F.size("reasons") > 0), LAPSE, F.lit("critical"), F.col("sentinel_id"), none, F.to_json(F.struct("reasons")), run_ts)
    return {"state": state, "items": a.unionByName(b)}


def set_sentinel(seen: DataFrame, previous: DataFrame, run_ts: Column) -> dict[str, DataFrame]:
    """The set of documents (sentinel_id, document) of a hub: ``state`` (what is seen now) and ``items``, seeded at first, else what appeared or went."""
    ids = previous.select("sentinel_id").distinct()
    new = seen.join(ids, "sentinel_id", "left_anti").groupBy("sentinel_id").agg(F.to_json(F.struct(F.array_sort(F.collect_set("document")).alias("documents"))).alias("_d"))
    diffs = set_changes(previous.select("sentinel_id", "document"), seen.select("sentinel_id", "document"), ["sentinel_id", "document"]).join(ids, "sentinel_id", "left_semi")
    at = lambda w: F.array_sort(F.collect_list(F.when(F.col("change") == w, F.col("document")))).alias(w)
    diffs = diffs.groupBy("sentinel_id").agg(F.to_json(F.struct(at("new"), at("removed"))).alias("_d"))
    none = F.lit(None).cast("array<string>")
    a = items(new, SET_SEEDED, F.lit("notice"), F.col("sentinel_id"), none, F.col("_d"), run_ts)
    return {"state": seen, "items": a.unionByName(items(diffs, DOCUMENTS_CHANGED, F.lit("warning"), F.col("sentinel_id"), none, F.col("_d"), run_ts))}


#: Kinds of sentinels, by name, and what checks them.
HANDLERS = {"quote": quote_sentinel, "set": set_sentinel}


def run_sentinels(chosen: DataFrame, inputs: dict[str, tuple], run_ts: Column) -> dict[str, DataFrame | str]:
    """Runs the handlers of the chosen sentinels (sentinel_id, handler); ``inputs``: handler -> its arguments but the last.

    Returns items, a state for each handler, and ``error:<handler>`` where one failed, which doesn't stop the others; its
    sentinels, and those of a handler that isn't known, are items: the check did not run.
    """
    out: dict[str, DataFrame | str] = {}
    parts, failed = [], []
    for name, run in HANDLERS.items():
        if name in inputs:
            try:
                got = run(*inputs[name], run_ts)
                out[f"state:{name}"], found = kept(got["state"]), kept(got["items"])
                parts.append(found)
            except Exception as e:  # noqa: BLE001  one check that fails doesn't stop the others
                out[f"error:{name}"] = str(e)
                failed.append(name)
    none = F.lit(None).cast("array<string>")
    idle = chosen.where(~F.coalesce(F.col("handler").isin([*inputs]) & F.col("handler").isin([*HANDLERS]), F.lit(False)))
    parts.append(items(idle, UNHANDLED, F.lit("warning"), F.col("sentinel_id"), none, F.to_json(F.struct("handler")), run_ts))
    parts.append(items(chosen.where(F.col("handler").isin(failed)), FAILED, F.lit("warning"), F.col("sentinel_id"), none, F.to_json(F.struct("handler")), run_ts))
    out["items"] = reduce(lambda a, b: a.unionByName(b), parts)
    return out


def lapsed_registry(sources: DataFrame, of_host: str, reason: str) -> DataFrame:
    """``sources`` prepared for review with every source of a host excluded, no longer fetched, for a reason."""
    hit = (host(F.col("url")) == of_host.lower()) & ~F.coalesce("excluded", F.lit(False))
    d = sources.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    blank = {c: F.when(F.col("_hit"), F.lit(None)).otherwise(F.col(c)) for c in ("method", "cadence") if c in sources.columns}
    return d.withColumns({**blank, "excluded": F.col("_hit") | F.coalesce("excluded", F.lit(False)), "exclusion_reason": F.when(F.col("_hit"), reason)}).drop("_hit")
