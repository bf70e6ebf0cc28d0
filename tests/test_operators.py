"""Diffs, events, dispatch, chains, integrity, guards and watch on small tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from chronodiff.operators import corroborate as C
from chronodiff.operators import diff, events, fold, guards, integrity, watch
from chronodiff.plans.reference_queries import REFERENCE as QUERIES
from chronodiff.streaming import ingest
from chronodiff.streaming.corroborate import dispatch_stream

T0 = dt.datetime(2026, 7, 1, 6, tzinfo=dt.UTC)
MODEL = "source_id string, id string, created bigint, owned_by string, endpoints array<string>, context_window bigint"


def h(x):
    return T0 + dt.timedelta(hours=x)


def got(d):
    return {tuple(r) for r in d.drop("source_id").collect()}


def test_models_diff(spark):
    prev = spark.createDataFrame([("s", "a", 1, None, ["x", "y"], 10), ("s", "b", None, "o", None, None), ("s", "c", 1, None, [], 5)], MODEL)
    cur = spark.createDataFrame([("s", "a", 2, None, ["y", "x"], 20), ("s", "b", None, "p", ["z"], None), ("s", "d", 1, None, [], 5), ("new", "q", 1, None, [], 1)], MODEL)
    assert got(diff.diff_models(prev, cur)) == {
        ("model.released", "models[].id", "added", "d", None, "d"), ("model.deprecated", "models[].id", "removed", "c", "c", None), ("limits.changed", "models[].context_window", "modified", "a", "10", "20"),
        ("capability.changed", "models[].endpoints", "modified", "b", "[]", '["z"]'), (None, "models[].created", "modified", "a", "1", "2"), (None, "models[].owned_by", "modified", "b", "o", "p"),
    }
    assert diff.diff_models(prev, prev).count() == 0 and diff.diff_models(prev.limit(0), cur).count() == 0


def test_prices_diff(spark):
    cols = "source_id string, model_ref string, direction string, tier string, region string, value double"
    prev = spark.createDataFrame([("s", "m", "input", "batch", "r", 1.0), ("s", "m", "input", "standard", "r", 1.25), ("s", "m", "input", "standard", "q", 2.0), ("s", "m", "output", "batch", "r", 4.0), ("s", "old", "input", "standard", "r", 1.0)], cols)
    cur = spark.createDataFrame([("s", "m", "input", "batch", "r", 0.5), ("s", "m", "input", "standard", "r", 1.0), ("s", "m", "input", "standard", "q", 2.0), ("s", "m", "output", "batch", "r", 5.0), ("s", "new", "input", "standard", "r", 1.0), ("s", "new", "output", "standard", "r", 1.0)], cols)
    c = {(r.model_ref, r.direction): (r.old, r.new, [(e.tier, e.old, e.new) for e in r.entries]) for r in diff.changed_prices(diff.price_rows(prev, cur)).collect()}
    assert c == {("m", "input"): (1.25, 1.0, [("batch", 1.0, 0.5), ("standard", 1.25, 1.0)]), ("m", "output"): (4.0, 5.0, [("batch", 4.0, 5.0)])}
    assert {tuple(r)[1:] for r in diff.price_row_counts(diff.price_rows(prev, cur)).collect()} == {("old", 0, 1, "removed"), ("new", 2, 0, "added")}
    assert diff.diff_prices(prev, cur).count() == 4
    r = spark.createDataFrame([(1.25, 1.0), (0.0, 3.0)], "o double, n double").select(events.percent_change(F.col("o"), F.col("n")).alias("p")).collect()
    assert [x.p for x in r] == [-20.0, 0.0]


def test_incidents_and_docs_diff(spark):
    cols = "source_id string, id string, status string, components array<string>"
    prev = spark.createDataFrame([("s", "1", "investigating", ["a"]), ("s", "2", "resolved", None), ("s", "3", "open", []), ("s", "gone", "open", [])], cols)
    cur = spark.createDataFrame([("s", "1", "resolved", ["a", "b"]), ("s", "2", "postmortem", []), ("s", "3", "monitoring", []), ("s", "4", None, [])], cols)
    assert got(diff.diff_incidents(prev, cur)) == {("outage.started", "incidents[].id", "added", "4", None, "4"), ("outage.resolved", "incidents[].status", "modified", "1", "investigating", "resolved"), (None, "incidents[].components", "modified", "1", '["a"]', '["a","b"]')}
    cols = "source_id string, extraction_rule_id string, field_path string, value string"
    prev = spark.createDataFrame([("s", "r", "models[a]", "1"), ("s", "r", "models[b]", "1"), ("s", "r", "sections[x]", "1"), ("t", "other", "models[a]", "1")], cols)
    cur = spark.createDataFrame([("s", "r", "models[b]", "2"), ("s", "r", "models[c]", "1"), ("s", "r", "sections[y]", "1"), ("t", "other", "models[z]", "1")], cols)
    assert got(diff.diff_docs(prev, cur, ["r"])) == {
        ("model.released", "models[].id", "added", "c", None, "c"), ("model.deprecated", "models[].id", "removed", "a", "a", None), (None, "models[b]", "modified", "b", "1", "2"), (None, "sections[x]", "removed", "sections[x]", "1", None),
        (None, "sections[y]", "added", "sections[y]", None, "1"), (None, "models[a]", "removed", "a", "1", None), (None, "models[z]", "added", "z", None, "1"),
    }


def test_last_row_of_a_repeated_key_counts(spark):
    cols = "source_id string, id string, status string, components array<string>, n int"
    prev = spark.createDataFrame([("s", "1", "open", [], 1)], cols)
    cur = spark.createDataFrame([("s", "1", "resolved", [], 2), ("s", "1", "open", [], 1)], cols)
    assert len(got(diff.diff_incidents(prev, cur, "n"))) == 1


SOURCES = {"docs": ("provider-docs", "provider-docs"), "api": ("official-api", "official-api"), "agg": ("third-party-aggregator", "provider-docs"), "agg2": ("third-party-aggregator", "provider-docs"), "probe": ("own-probe", "own-probe")}


def change(hours, old, new, source, event_type="price.changed", absence=False, key="m", path="p"):
    cls, line = SOURCES[source]
    return {"provider": "x", "model": key, "event_type": event_type, "field_path": path, "old": old, "new": new, "observed_at": h(hours), "source_id": source, "source_class": cls, "lineage": line, "absence": absence}


SCHEMA = "provider string, model string, event_type string, field_path string, old string, new string, observed_at timestamp, source_id string, source_class string, lineage string, absence boolean"

SEQUENCES = [
    ([(0, "2.5", "2.0", "docs"), (10, "2.5", "2.0", "api")], ["mint", "corroborated"]),
    ([(0, "2.5", "2.0", "agg"), (5, "2.5", "2.0", "agg2")], ["mint", "mirror"]),
    ([(0, "2.5", "2.0", "docs"), (5, "2.5", "2.0", "agg")], ["mint", "mirror"]),
    ([(0, "2.5", "2.0", "docs"), (5, "2.5", "2.0", "probe")], ["mint", "corroborated"]),
    ([(0, "2.5", "2.0", "docs"), (30, "2.5", "2.0", "docs")], ["mint", "already"]),
    ([(0, "2.5", "2.0", "docs"), (72, "2.5", "2.0", "api")], ["mint", "mint"]),
    ([(0, "2.5", "2.0", "docs"), (5, "2.5", "2.1", "agg")], ["mint", "discrepancy"]),
    ([(0, "2.5", "2.0", "docs"), (30, "2.0", "1.8", "docs")], ["mint", "mint"]),
    ([(0, "2.5", "2.0", "docs"), (5, "3.0", "2.0", "api")], ["mint", "corroborated"]),
    ([(0, "2.5", "2.0", "docs"), (24, "2.0", "2.5", "docs")], ["mint", "rollback"]),
    ([(0, "2.5", "2.0", "docs"), (12, "2.0", "2.5", "docs"), (20, "2.5", "2.0", "api"), (30, "2.0", "2.5", "docs")], ["mint", "rollback", "flap", "flap"]),
    ([(0, "2.5", "2.0", "docs"), (50, "2.0", "2.5", "docs")], ["mint", "mint"]),
    ([(0, None, "m", "api", "model.released"), (20, "m", None, "api", "model.deprecated", True)], ["mint", "rollback"]),
    ([(0, "m", None, "api", "model.deprecated", True), (10, "m", None, "agg", "model.deprecated", True)], ["mint", "mirror"]),
    ([(0, "m", None, "api", "model.deprecated", True), (10, "m", None, "docs", "model.deprecated")], ["mint", "corroborated"]),
    ([(0, "m", None, "api", "model.deprecated", True), (10, "m", None, "probe", "model.deprecated")], ["mint", "corroborated"]),
    ([(0, None, "i1", "api", "outage.started"), (1, None, "i2", "docs", "outage.started")], ["mint", "discrepancy"]),
    ([(0, "a", "b", "api", "outage.started"), (25, "b", "a", "api", "outage.started")], ["mint", "mint"]),
]


def observed(spark):
    rows = [change(*c, key=f"m{i}") for i, (seq, _) in enumerate(SEQUENCES) for c in seq]
    d = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    # The id of one change seen twice is the same; the sequence is told apart by its model.
    key = events.I.key_text(F.col("provider"), F.col("model"), F.col("event_type"), F.col("field_path"), events.json_value(F.col("old")), events.json_value(F.col("new")))
    inverse = events.I.key_text(F.col("provider"), F.col("model"), events.reversed_type(F.col("event_type")), F.col("field_path"), events.json_value(F.col("new")), events.json_value(F.col("old")))
    return d.withColumns({"id": events.I.event_id(key, F.col("observed_at")), "hash8": events.I.hash8(key), "inverse8": events.I.hash8(inverse)})


def by_model(spark, out):
    names = {(r.id, r.source_id, r.at): r.model for r in observed(spark).select("id", "source_id", F.unix_micros("observed_at").alias("at"), "model").collect()}
    seq = {}
    for r in sorted(out, key=lambda r: r.at):
        seq.setdefault(names[r.id, r.source_id, r.at], []).append(r.action)
    return seq


WANT = {f"m{i}": want for i, (_, want) in enumerate(SEQUENCES)}


def test_dispatch(spark):
    assert by_model(spark, C.dispatch(observed(spark)).collect()) == WANT
    assert C.dispatch(observed(spark).limit(0)).count() == 0


def test_dispatch_against_stored(spark):
    o = observed(spark)
    out = C.dispatch(o.where(F.col("observed_at") > T0), o.where(F.col("observed_at") == T0)).collect()
    assert by_model(spark, out) == {k: v[1:] for k, v in WANT.items()}


def test_dispatch_as_stream(spark, tmp_path):
    # One file per hour, in order of time.
    o = observed(spark)
    for i, x in enumerate(sorted({r.observed_at for r in o.select("observed_at").collect()})):
        o.where(F.col("observed_at") == x).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"f{i:03d}"))
    stream = spark.readStream.schema(o.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    q = dispatch_stream(stream, "96 hours").writeStream.format("memory").queryName("dispatched").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    batch = {(r.id, r.source_id, r.at): (r.action, r.candidate) for r in C.dispatch(o).collect()}
    assert {(r.id, r.source_id, r.at): (r.action, r.candidate) for r in spark.table("dispatched").collect()} == batch


LISTED = [("docs", "provider-docs", "provider-primary"), ("api", "official-api", "provider-primary"), ("agg", "third-party-aggregator", "third-party-aggregator")]


def corroborated(spark, path, rows):
    """Actions by (hour, source) of change events (row_id, id, model, hour, landed hour, evidence sources)."""
    spark.createDataFrame(LISTED, "source_id string, source_class string, lineage string").write.parquet(f"{path}/sources.parquet")
    e = spark.createDataFrame([(r, i, "x", m, "model.released", h(at), h(landed), [(s,) for s in ids]) for r, i, m, at, landed, ids in rows],
                              "row_id bigint, id string, provider string, model_id string, event_type string, observed_at timestamp, landed_at timestamp, evidence array<struct<source_id string>>")
    e.write.parquet(f"{path}/change_events.parquet")
    out = QUERIES["corroborate_batch"](spark, str(path)).collect()
    return sorted(((r.at - int(T0.timestamp() * 1e6)) // 3_600_000_000, r.source_id, r.action) for r in out)


def test_dispatch_knows_all_cited_sources(spark, tmp_path):
    a = [(1, "e1", "a", 0, 0, ["docs", "agg"]), (2, "e2", "a", 30, 30, ["agg"])]  # the second source is known
    b = [(3, "e3", "b", 1, 0, ["agg"]), (4, "e4", "b", 31, 31, ["docs", "api"])]  # the second one is independent
    c = [(5, "e5", "c", 2, 0, [None, "docs"]), (6, "e6", "c", 32, 32, ["unlisted", "api"])]
    d = [(7, "e7", "d", 3, 3, ["docs"]), (8, "e7", "d", 3, 2, ["docs", "agg"]), (9, "e7", "d", 3, 4, ["api"]), (10, "e8", "d", 33, 33, ["agg"])]  # the first delivery counts
    e = [(11, "e9", "e", 4, 4, []), (12, "e10", "e", 34, 34, [None]), (13, "e11", "e", 58, 58, [])]
    want = [(0, "docs", "mint"), (30, "agg", "already"), (1, "agg", "mint"), (31, "docs", "corroborated"), (2, None, "mint"), (32, "unlisted", "corroborated"),
            (3, "docs", "mint"), (33, "agg", "already"), (4, None, "mint"), (34, None, "mirror"), (58, None, "already")]
    assert corroborated(spark, tmp_path, a + b + c + d + e) == sorted(want)


def test_dispatch_takes_each_observation_of_a_day(spark, tmp_path):
    a = [(1, "e1", "a", 0, 0, ["agg"]), (2, "e2", "a", 5, 5, ["docs"]), (3, "e3", "a", 9, 9, ["api"]), (4, "e4", "a", 10, 10, ["agg", "api"]), (5, "e5", "a", 24, 24, ["docs"])]
    b = [(6, "e6", "b", 1, 2, ["docs"]), (7, "e7", "b", 1, 1, ["agg"]), (8, "e8", "b", 25, 25, ["docs"])]  # two at one instant are united
    want = [(0, "agg", "mint"), (5, "docs", "mirror"), (9, "api", "corroborated"), (10, "agg", "already"), (24, "docs", "already"), (1, "agg", "mint"), (25, "docs", "already")]
    assert corroborated(spark, tmp_path, a + b) == sorted(want)


def test_long_urls_keep_their_ends(spark, tmp_path):
    long = "https://x.example/" + "a" * 600
    spark.createDataFrame([("one", long + "/1"), ("two", long + "/2"), ("cut", long[:508])], "source_id string, url string").write.parquet(f"{tmp_path}/sources.parquet")
    spark.createDataFrame([(1, long + "/1"), (2, long + "/2"), (3, long + "/3"), (4, long[:508])], "row_id bigint, url string").write.parquet(f"{tmp_path}/manifests.parquet")
    assert {(r.row_id, r.source_id) for r in QUERIES["sources_of_urls"](spark, str(tmp_path)).collect()} == {(1, "one"), (2, "two"), (3, None), (4, "cut")}


def test_state_round_trip():
    opened = [C.Open("a", "t", 1, None, "x", "h", True, {"s": ("c", "l")}, True)]
    assert C.load(C.dump(opened)) == opened


def test_mint_and_exceptions(spark):
    cols = "provider string, model string, event_type string, field_path string, old string, new string, observed_at timestamp"
    d = spark.createDataFrame([("p", "m", "limits.changed", "c", "1", "2", T0), ("p", "m", "limits.changed", "c", "1", "2", h(1)), (None, "m", "limits.changed", "c", "1", "2", T0), ("p", None, "limits.changed", "c", "1", "2", T0), ("p", None, "outage.started", "c", None, "i", T0), ("p", "m", None, "c", "1", "2", T0)], cols)
    good, bad = events.mint(d)
    assert good.count() == 2 and {r.observed_at.hour for r in good.collect()} == {6} and {r.reason for r in bad.collect()} == {"provider-unmapped", "alias-unmapped", "unclassified"}
    assert all(r.id.startswith("evt_20260701_") and r.id.endswith(r.hash8) for r in good.collect())


def test_windows_are_strict(spark):
    e = spark.createDataFrame([(1, "k", h(0)), (2, "k", h(72)), (3, "k", h(143.99)), (4, None, h(0)), (5, None, h(1))], "id int, k string, at timestamp")
    assert {r.id for r in events.repeated_within(e, ["k"], "at", ["id"]).collect()} == {3, 5}
    out = {r.id: r.candidate for r in events.latest_within(e, e, ["k"], "at", "id").collect()}
    assert out == {1: None, 2: None, 3: 2, 4: None, 5: 4}


def test_independence(spark):
    data = [("docs", "provider-docs", "provider-primary", False), ("api", "official-api", "provider-primary", False), ("agg", "third-party-aggregator", "third-party-aggregator", False), ("mirror", "official-api", "provider-primary", True), ("none", None, None, False)]
    d = spark.createDataFrame(data, "n string, c string, l string, m boolean").select("n", F.struct(F.col("c").alias("source_class"), events.lineage(F.col("c"), F.col("l"), F.col("m")).alias("lineage")).alias("t"))
    p = d.alias("a").join(d.alias("b"), F.col("a.n") < F.col("b.n")).where(events.independent(F.col("a.t"), F.col("b.t")))
    assert {(r[0], r[2]) for r in p.collect()} == {("api", "docs"), ("agg", "api")}


CHAIN = [("confirm", 1, 1), ("discrepancy", 0, 2), ("reject", 1, 3), ("confirm", 1, 4), ("note", 0, 5), ("discrepancy", 0, 4)]


def test_fold(spark):
    rows = [("e", h(t), r, i, k) for i, (k, r, t) in enumerate(CHAIN)]
    c = spark.createDataFrame(rows, "event_id string, ts timestamp, rank int, seq int, kind string")
    for n in range(6):
        part = c.where(F.col("ts") <= h(n))
        state, opened = "unconfirmed", False
        for k, r, t in sorted(CHAIN, key=lambda x: (x[2], x[1])):
            if t <= n:
                state, opened = (fold.DECIDES[k], False) if k in fold.DECIDES else (state, opened or k == "discrepancy")
        want = [(state, opened)] if n else []
        assert [(r.status, r.discrepancy_open) for r in fold.fold(part).collect()] == want
        at = spark.createDataFrame([("i", "e", h(n))], "i string, event_id string, at timestamp")
        assert [(r.status, r.discrepancy_open) for r in fold.as_of(c, at, "i").collect()] == [(state, opened)]
    assert [r.status for r in fold.running(c).orderBy("ts", "rank", "seq").collect()] == ["confirmed", "confirmed", "rejected", "rejected", "confirmed", "confirmed"]


def test_integrity(spark):
    f = spark.createDataFrame([("a", '{"id": "x1", "n": 3, "tags": ["t"], "kind": "k"}'), ("b", '{"id": "BAD", "n": 2.5, "tags": [], "kind": "z", "more": 1}'), ("c", '{"n": 1'), ("d", "{}")], "path string, text string")
    schema = {"type": "object", "required": ["id", "n"], "additionalProperties": False, "properties": {"id": {"pattern": "^[a-z0-9]+$", "maxLength": 2}, "n": {"type": "integer"}, "tags": {"minItems": 1}, "kind": {"enum": ["k"]}}}
    assert [r.subject for r in integrity.unreadable(f).collect()] == ["c"]
    assert {(r.subject, r.message) for r in integrity.invalid(f, schema).collect()} == {("b", "/id: does not match the pattern"), ("b", "/id: too long"), ("b", "/n: not of type integer"), ("b", "/tags: too few items"), ("b", "/kind: not one of the values"), ("b", "/: unknown more"), ("d", "/: id is missing"), ("d", "/: n is missing")}
    p = spark.createDataFrame([("/s/events/2026/07/evt_20260701_aaaaaaaa.json", "evt_20260701_aaaaaaaa"), ("/s/events/2026/08/evt_20260701_aaaaaaaa.json", "evt_20260701_aaaaaaaa")], "path string, id string")
    assert integrity.misplaced(p).count() == 1
    ev = spark.createDataFrame([("evt_20260701_aaaaaaaa", T0, "t", "p"), ("evt_20260702_aaaaaaaa", h(30), "t", "p"), ("evt_20260701_bbbbbbbb", h(48), "t", "p"), ("x", T0, "t", "p"), ("x", T0, "t", "p")], "id string, observed_at timestamp, event_type string, provider string")
    assert {r.subject for r in integrity.wrong_ids(ev).collect()} == {"evt_20260701_bbbbbbbb", "x"}
    assert {(r.subject, r.message[:2]) for r in integrity.duplicates(ev).collect()} == {("x", "id"), ("evt_20260702_aaaaaaaa", "th")}
    k = spark.createDataFrame([("evt_20260701_aaaaaaaa", "text", "t", "p")], "event_id string, text string, event_type string, provider string")
    assert integrity.key_mismatch(ev, k).count() == 1
    g = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 3), ("c", 2)], "k string, s int")
    assert {r.subject for r in integrity.gaps(g, "k", "s").collect()} == {"b", "c"}


def test_guards(spark):
    doc = {"headers": {"Authorization": "x", "Accept": "y"}, "a": [{"url": "https://h/p?token=1"}, {"t": "sk-abcdefghijklmnopqrstu"}, 5, None], "Cookie": ""}
    d = spark.createDataFrame([(1, json.dumps(doc)), (2, "{"), (3, None)], "k bigint, t string")
    assert {(r.pointer, r.why) for r in guards.secrets(guards.pointers(d, "k", "t"), "k").collect()} == {("/headers/Authorization", "header"), ("/a/0/url", "parameter"), ("/a/1/t", "token")}
    t = spark.createDataFrame([(1, "x\nmail bob@corp.example and a@b.example.org"), (2, None)], "k bigint, t string")
    assert {tuple(r) for r in guards.emails(guards.text_lines(t, "k", "t"), "k", "line", "text", ["corp.example"]).collect()} == {(1, 2, "a***@b.example.org")}
    p = spark.createDataFrame([("a/compliance/consent/x", True), ("compliance/consent", True), ("a/compliance-consent", False)], "p string, w boolean")
    assert all(r.g == r.w for r in p.select(guards.forbidden_pair(F.col("p"), "compliance/consent").alias("g"), "w").collect())
    w = spark.createDataFrame([("A\tevents/a",), ("M\tevents/b",), ("R100\tevents/c\tother/c",), ("D\tother/d",)], "line string")
    assert {tuple(r) for r in guards.rewrites(w, ["events/"]).collect()} == {("M", "events/b"), ("R", "events/c")}


ROBOTS = "User-agent: *\nDisallow: /private\nAllow: /private/open\n\nUser-agent: Bot\nUser-agent: other\nDisallow: /\nCrawl-delay: 5\nContent-Signal: search=yes, ai-train=no\nContent-Signal: ai-train=yes # later\nUser-agent: star\nDisallow: /*.pdf$\nDisallow: /a/*/private\n"


@pytest.mark.parametrize("agent, path, allowed", [("x", "/a", True), ("x", "/private/a", False), ("x", "/private/open/a", True), ("BOT/1 (x)", "/a", False), ("mybot/1", "/a", True), ("star", "/x/a.pdf", False), ("star", "/x/a.pdf?b", True), ("star", "/docs", True), ("star", "/a/1/private", False), ("star", "/a/1/public", True)])
def test_stances(spark, agent, path, allowed):
    d = spark.createDataFrame([("h", ROBOTS, path), ("g", None, path)], "host string, t string, p string")
    out = {r.host: r.stance for r in watch.stances(d, "t", "p", agent).collect()}
    assert out["h"].allowed == allowed and out["g"].allowed and out["g"].rules == []
    if agent == "BOT/1 (x)":
        assert out["h"].crawl_delay == "5" and out["h"].signals == {"search": "yes", "ai-train": "yes"}


def test_stance_of_a_host_without_file(spark):
    d = spark.createDataFrame([(404, None, True), (503, ROBOTS, False), (None, None, False), (200, "", True)], "s int, t string, want boolean")
    assert all(r.stance.allowed == r.want for r in watch.stances(d.withColumn("p", F.lit("/a")), "t", "p", "x", "s").collect())


def test_watch(spark):
    d = spark.createDataFrame([("h", ROBOTS, "/a")], "host string, t string, p string")
    a, b = watch.stances(d, "t", "p", "x"), watch.stances(d, "t", "p", "bot")
    assert {r.field for r in watch.stance_changes(a, b).collect()} == {"allowed", "rules", "crawl_delay"} and watch.stance_changes(a, a).count() == 0
    s = spark.createDataFrame([(200, "ok"), (404, "absent"), (429, "unreachable"), (503, "unreachable"), (None, "unreachable")], "s int, w string")
    assert all(r.g == r.w for r in s.select(watch.fetched_as(F.col("s")).alias("g"), "w").collect())
    x = spark.createDataFrame([("One. The Service is excluded! Two? the excluded service.",)], "t string")
    assert x.select(watch.sentences_with(F.col("t"), "service", "excluded").alias("s")).first().s == ["The Service is excluded!", "the excluded service."]
    q = spark.createDataFrame([("a  quote here",), ("nothing",)], "t string")
    assert [r.state for r in watch.quote_state(q, "t", "quote here", None).collect()] == ["quoted", "lapsed"] and watch.quote_state(q, "t", "quote here", "0").first().state == "changed"


def test_stream_of_all_observations_is_the_batch(spark):
    sf = "/root/testdata/sf0.001"
    rows = lambda q: sorted(map(tuple, QUERIES[q](spark, sf).collect()), key=repr)
    assert rows("corroborate_stream") == rows("corroborate_batch") != []


def test_small_lookups(spark):
    d = spark.createDataFrame([("docs/a", True), ("docs", True), ("docsy/a", False), ("x/y", True), (None, None)], "p string, w boolean")
    assert all(r.g == r.w for r in d.select(guards.allowed(F.col("p"), ["docs/", "x"]).alias("g"), "w").collect())
    e = spark.createDataFrame([([("a", None), ("b", "m0"), ("a", "m1"), ("a", "m2")], "a", ["x", None], "m1", False), ([], "a", ["flap"], None, True), (None, "a", None, None, False)], "e array<struct<source_id string, manifest_path string>>, s string, k array<string>, m string, f boolean")
    assert all((r.g, r.o) == (r.m, r.f) for r in e.select(events.first_own_manifest(F.col("e"), F.col("s")).alias("g"), events.kinds_overlap(F.col("k"), ["flap", "rollback"]).alias("o"), "m", "f").collect())


def test_outcomes(spark):
    rows = [("n1", "mint", None, "s", 1), ("n2", "corroborated", "n1", "t", 2), ("n2", "corroborated", "n1", "t", 2), ("n3", "mirror", "n1", "u", 3), ("n4", "already", "n1", "t", 4), ("n5", "rollback", "n1", None, 5), ("n6", "discrepancy", "n1", "s", 6)]
    out = C.outcomes(spark.createDataFrame(rows, C.OUT))
    assert {tuple(r) for r in out["annotations"].collect()} == {("n1", "corroboration", 2, "n2", "t"), ("n1", "mirror-corroborated", 3, "n3", "u"), ("n1", "rollback", 5, "n5", None), ("n1", "discrepancy", 6, "n6", "s")} and out["annotations"].count() == 4
    assert [tuple(r) for r in out["drafts"].collect()] == [("n1", "n2")] and [tuple(r) for r in out["exceptions"].collect()] == [("n1", "value-conflict", "n6")]


def test_pieces_of_a_key(spark):
    at = [0, 71, 143, 215, 216, 300, 400]
    d = spark.createDataFrame([("p", None, "f", "x", C.HOUR * a) for a in at] + [("q", None, "f", "x", 5)], "provider string, model string, field_path string, family string, at bigint")
    out = {(r.provider, r.at // C.HOUR): r._piece // C.HOUR for r in C.pieces(d.unionByName(d)).collect()}
    assert out == {("p", 0): 0, ("p", 71): 0, ("p", 143): 143, ("p", 215): 215, ("p", 216): 215, ("p", 300): 300, ("p", 400): 400, ("q", 0): 0}
    assert C.pieces(d.limit(0)).count() == 0


def test_ingest(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "id string, v int")
    inbox, table, check = (str(tmp_path / x) for x in ("in", "t", "c"))
    rows(("a", 1), ("b", 2)).write.parquet(f"{inbox}/1")
    take = lambda: ingest.ingest(ingest.landed(spark, inbox, "id string, v int"), table, "id", check)
    take()
    rows(("b", 9), ("c", 3)).write.parquet(f"{inbox}/2")
    take()
    take()
    assert {tuple(r) for r in spark.read.parquet(table).collect()} == {("a", 1), ("b", 2), ("c", 3)}
