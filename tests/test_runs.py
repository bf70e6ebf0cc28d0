"""A whole collection, the watch jobs, and the tables they write."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronodiff.operators import collect as K
from chronodiff.operators import watch
from chronodiff.sources import fetch, normalize, registry, store

AT = dt.datetime(2026, 7, 1, 6, tzinfo=dt.UTC)
TASKS = [
    K.Task("router", "router-models", "models", "router"),
    K.Task("mirror", "mirror-models", "models", "router"),
    K.Task("costs", "costs-prices", "token-prices", "costs"),
    K.Task("pulse", "pulse-status", "status-json", provider="acme"),
    K.Task("pages", "acme-page", "page", "acme", options=(K.pages.Rule(),)),
]


def landed(spark, **bodies):
    return spark.createDataFrame([(s.replace("_", "-"), AT, b if isinstance(b, str) else json.dumps(b)) for s, b in bodies.items()], "source_id string, run_ts timestamp, payload string")


def tables(spark):
    aliases = spark.createDataFrame([("router", "acme/a", "a"), ("router", "acme/b", "b"), ("router", "acme/c", "c"), ("costs", "m1", "m"), ("router", "nobody/z", "z")], "namespace string, alias string, canonical_id string")
    providers = spark.createDataFrame([("router", "acme", "acme"), ("costs", None, "acme")], "namespace string, prefix string, provider string")
    sources = spark.createDataFrame([("router-models", "third-party-aggregator", "third-party"), ("mirror-models", "official-api", "provider-primary")], "source_id string, source_class string, lineage string")
    return aliases, providers, sources


def model(i, n=8):
    return {"id": i, "created": 1, "context_length": n, "architecture": {"input_modalities": ["text"]}}


def run(spark, previous, **bodies):
    return K.collect(landed(spark, **bodies), TASKS, previous, *tables(spark))


def test_collect(spark, tmp_path):
    page = "<main><h2>One</h2><p>x</p></main>"
    first = run(spark, {}, router_models={"data": [model("acme/a"), model("acme/b")]}, costs_prices={"m1": {"input_cost_per_token": 1e-6}}, pulse_status={"incidents": [{"id": "i1", "status": "investigating", "updated_at": "t"}]}, acme_page=page)
    assert first["deltas"].count() == 0 and first["events"].count() == 0
    before = {k.split(":")[1]: v for k, v in first.items() if k.startswith("snapshot:")}
    assert set(before) == {"models-api", "pricing-api", "statuspage", "docs-html"}
    again = run(spark, before, router_models={"data": [model("acme/a", 9), model("acme/c"), model("acme/unknown"), model("nobody/z")]}, costs_prices={"m1": {"input_cost_per_token": 2e-6}, "m2": {"input_cost_per_token": 1e-6}},
                pulse_status={"incidents": [{"id": "i1", "status": "resolved", "updated_at": "t"}, {"id": "i2", "status": "investigating", "updated_at": "t"}]}, acme_page=page.replace("x", "y"))
    ev = {(r.event_type, r.subject): r for r in again["events"].collect()}
    assert set(ev) == {("limits.changed", "acme/a"), ("model.deprecated", "acme/b"), ("model.released", "acme/c"), ("price.changed", "m1"), ("outage.resolved", "i1"), ("outage.started", "i2")}
    assert ev["limits.changed", "acme/a"].model == "a" and json.loads(ev["limits.changed", "acme/a"].data) == {"limit_kind": "context", "old": 8.0, "new": 9.0}
    assert json.loads(ev["price.changed", "m1"].data)["pct_change"] == 100.0 and "+100.0000%" in ev["price.changed", "m1"].summary
    assert ev["outage.resolved", "i1"].field_path == "incidents[id=i1].status" and ev["outage.resolved", "i1"].provider == "acme" and ev["outage.resolved", "i1"].model is None
    assert json.loads(ev["model.deprecated", "acme/b"].data) == {"source_kind": "api-absence"} and ev["model.released", "acme/c"].source_ids == ["router-models"]
    assert {(r.reason, r.subject) for r in again["exceptions"].collect()} == {("alias-unmapped", "acme/unknown"), ("provider-unmapped", "nobody/z"), ("unclassified", "m2"), ("unclassified", "sections[one]")}
    assert {(r.collector, r.sources, r.landed, r.deltas, r.events, r.exceptions, r.status) for r in again["report"].collect()} == {
        ("router", 1, 1, 5, 3, 2, "ok"), ("mirror", 1, 0, 0, 0, 0, "failed"), ("costs", 1, 1, 2, 1, 1, "ok"), ("pulse", 1, 1, 2, 2, 0, "ok"), ("pages", 1, 1, 1, 0, 1, "ok")}
    assert {r.action for r in again["actions"].collect()} == {"mint"} and again["actions"].count() == 6
    store.publish_run({k.replace(":", "-"): v for k, v in again.items()}, str(tmp_path / "store"), "r2")
    assert store.published(spark, str(tmp_path / "store"), "events").count() == 6


def test_two_sources_of_one_change(spark):
    first = run(spark, {}, router_models={"data": []}, mirror_models={"data": [model("acme/a")]})
    # A source whose first listing is empty has no earlier rows, so no deltas; with one row it has.
    before = {"models-api": first["snapshot:models-api"].unionByName(run(spark, {}, router_models={"data": [model("acme/a")]})["snapshot:models-api"])}
    out = run(spark, before, router_models={"data": [model("acme/a"), model("acme/b")]}, mirror_models={"data": [model("acme/a"), model("acme/b")]})
    assert [(r.subject, r.source_ids) for r in out["events"].collect()] == [("acme/b", ["mirror-models", "router-models"])]
    assert {r.reason for r in out["exceptions"].collect()} == set()


def test_catalogue(spark):
    assert K.catalogue(spark, TASKS).where("kind = 'models-api'").count() == 2
    with pytest.raises(ValueError):
        K.catalogue(spark, [TASKS[0], TASKS[0]])
    d = spark.createDataFrame([("s", "b"), ("s", "B"), ("r", "z")], "source_id string, id string")
    assert [tuple(r) for r in K.canonical_order(d, "models-api").collect()] == [("r", "z"), ("s", "B"), ("s", "b")]


def test_recheck(spark):
    hosts = spark.createDataFrame([("a.x", ["s1", "s2"]), ("b.x", ["s3"]), ("c.x", ["s4"])], "host string, source_ids array<string>")
    sources = spark.createDataFrame([("s1", "https://a.x/in"), ("s2", "https://a.x/open"), ("s3", "https://b.x/p"), ("s4", "https://c.x/p")], "source_id string, url string")
    pins = spark.createDataFrame([("s1", "search", "yes"), ("s3", "search", "yes")], "source_id string, signal string, pinned string")
    ok = "User-agent: *\nDisallow: /no\nContent-Signal: search=yes"
    answers = lambda *rows: spark.createDataFrame(rows, "host string, http_status int, body string")
    none = spark.createDataFrame([], "host string, source_id string, stance struct<allowed boolean, rules array<string>, crawl_delay string, signals map<string,string>>, fetched string")
    at = F.lit("2026-07-01T00:00:00Z")
    first = watch.recheck(hosts, answers(("a.x", 200, ok), ("b.x", 200, ok), ("c.x", 503, None)), sources, none, pins, "bot/1", at)
    assert {(r.kind, r.severity, r.subject) for r in first["items"].collect()} == {("robots.state-seeded", "notice", "a.x"), ("robots.state-seeded", "notice", "b.x"), ("robots.state-seeded", "notice", "c.x"), ("robots.unreachable", "warning", "c.x")}
    prev = first["state"].select("host", "source_id", "stance", "fetched")
    then = watch.recheck(hosts, answers(("a.x", 200, ok + "\nDisallow: /in"), ("b.x", 200, ok.replace("yes", "no")), ("c.x", 404, None)), sources, prev, pins, "bot/1", at)
    got = {(r.kind, r.subject): r for r in then["items"].collect()}
    assert {k: r.severity for k, r in got.items()} == {("robots.stance-changed", "a.x"): "critical", ("robots.stance-changed", "b.x"): "warning", ("robots.stance-changed", "c.x"): "warning", ("robots.content-signals-mismatch", "b.x"): "critical"}
    assert {c["field"] for c in json.loads(got["robots.stance-changed", "a.x"].details)} == {"rules", "allowed:s1"} and got["robots.stance-changed", "a.x"].source_ids == ["s1", "s2"]
    assert {(r.host, r.fetched, r.seeded, r.changed) for r in then["report"].collect()} == {("a.x", "ok", False, True), ("b.x", "ok", False, True), ("c.x", "absent", False, True)}
    same = watch.recheck(hosts, answers(("a.x", 200, ok), ("b.x", 200, ok), ("c.x", 503, None)), sources, prev, pins, "bot/1", at)
    assert {r.kind for r in same["items"].collect()} == {"robots.unreachable"}


def test_sentinels(spark):
    all_of = spark.createDataFrame([("q", "weekly", "quote"), ("r", "weekly", "quote"), ("hub", "weekly", "set"), ("odd", "weekly", "none"), ("g", "weekly", "quote"), ("d", "daily", "quote")], "sentinel_id string, cadence string, handler string")
    chosen = watch.selected(all_of, cadence="weekly", everywhere=["g"])
    assert {r.sentinel_id for r in chosen.collect()} == {"q", "r", "hub", "odd"} and {r.sentinel_id for r in watch.selected(all_of, ["d"]).collect()} == {"d"}
    with pytest.raises(PySparkException):
        watch.selected(all_of, ["nope"]).collect()
    docs = spark.createDataFrame([("q", "One. The service is excluded here.  Two.", "whole"), ("r", "Nothing.", "w2")], "sentinel_id string, sentence_text string, hashed_text string")
    refs = spark.createDataFrame([("q", None, None), ("r", "The old sentence.", "0")], "sentinel_id string, quote string, digest string")
    seen = spark.createDataFrame([("hub", "/a"), ("hub", "/c")], "sentinel_id string, document string")
    prev = spark.createDataFrame([("hub", "/a"), ("hub", "/b")], "sentinel_id string, document string")
    at = F.lit("t")
    out = watch.run_sentinels(chosen, {"quote": (docs, refs, ("service", "excluded")), "set": (seen, prev)}, at)
    got = {(r.kind, r.subject): r.details for r in out["items"].collect()}
    assert set(got) == {("sentinel.reference-seeded", "q"), ("sentinel.verdict-lapse", "r"), ("sentinel.document-appeared", "hub"), ("sentinel.unhandled", "odd")}
    assert json.loads(got["sentinel.verdict-lapse", "r"]) == {"reasons": ["sentence removed or modified", "text changed"]} and json.loads(got["sentinel.document-appeared", "hub"]) == {"new": ["/c"], "removed": ["/b"]}
    state = {r.sentinel_id: r for r in out["state:quote"].collect()}
    assert state["q"].quote == "The service is excluded here." and state["q"].status == "seeded" and state["r"].status == "triggered"
    kept = watch.quote_sentinel(docs.where("sentinel_id = 'q'"), out["state:quote"].drop("status"), ("service",), at)
    assert kept["items"].count() == 0 and kept["state"].first().status == "ok"
    bad = watch.run_sentinels(chosen, {"quote": (docs, refs.drop("quote"), ("service",)), "set": (seen, prev.limit(0))}, at)
    assert "error:quote" in bad and {(r.kind, r.subject) for r in bad["items"].collect()} >= {("sentinel.failed", "q"), ("sentinel.failed", "r"), ("sentinel.state-seeded", "hub")}
    reg = spark.createDataFrame([("a", "https://Docs.x/1", "GET", "daily", False), ("b", "https://other.x/1", "GET", "daily", None)], "source_id string, url string, method string, cadence string, excluded boolean")
    assert {tuple(r)[2:] for r in watch.lapsed_registry(reg, "docs.x", "why").collect()} == {(None, None, True, "why"), ("GET", "daily", False, None)}
    with pytest.raises(PySparkException):
        watch.items(all_of, "k", F.lit("fatal"), F.col("sentinel_id"), F.lit(None).cast("array<string>"), F.lit(""), at).collect()


def test_tables_of_runs(spark, tmp_path):
    ev = spark.createDataFrame([("evt_20260701_aaaaaaaa", 1), ("evt_20260802_bbbbbbbb", 2), ("evt_20260702_cccccccc", 3), ("bad", 4)], "id string, v int")
    assert [r.id for r in store.event_ids(ev.unionByName(ev)).collect()] == ["evt_20260701_aaaaaaaa", "evt_20260702_cccccccc", "evt_20260802_bbbbbbbb"]
    path = str(tmp_path / "events")
    store.write_events(ev.where("v < 4"), path)
    d = store.events_of(spark, path, ["evt_20260702_cccccccc", "evt_20260702_none0000"])
    assert [tuple(r) for r in d.collect()] == [("evt_20260702_cccccccc", 3)] and len(d.inputFiles()) >= 1
    assert "PartitionFilters: [" in (plan := d._jdf.queryExecution().toString()) and "year" in plan.split("PartitionFilters: [")[1][:200]
    q = spark.createDataFrame([("robots", "2026-07-01T00-00-00Z", "k", "s")], "emitter string, run_ts string, kind string, subject string")
    assert store.write_json(q, str(tmp_path / "queue")) and not store.write_json(q.limit(0), str(tmp_path / "none")) and not (tmp_path / "none").exists()
    assert [json.loads(f.read_text()) for f in (tmp_path / "queue").rglob("*.json")] == [{"kind": "k", "subject": "s"}]
    assert store.write_json(q, str(tmp_path / "report"), as_lines=False) and [f.read_text() for f in (tmp_path / "report").rglob("*.txt")] == ['{\n  "kind" : "k",\n  "subject" : "s"\n}\n']
    errors = spark.createDataFrame([("E", "s", "m")], "code string, subject string, message string")
    assert store.write_if_green(q, errors.limit(0), str(tmp_path / "state")) and not store.write_if_green(q.limit(0), errors, str(tmp_path / "state")) and spark.read.parquet(str(tmp_path / "state")).count() == 1
    r = spark.createDataFrame([("r1", json.dumps({"collectors": {"c": {"verdict_drafts": [{"event_id": "b"}, {}]}, "d": {}}})), ("r0", json.dumps({"collectors": {"c": {"verdict_drafts": [{"event_id": "b"}]}}})), ("r2", "{}"), ("r3", None)], "run string, report string")
    assert [tuple(x) for x in store.drafts(r).collect()] == [("b", "r0")]
    assert [tuple(x) for x in store.review_order(store.drafts(r), spark.createDataFrame([("c",), ("a",), ("b",), (None,)], "id string")).collect()] == [("b", True), ("a", False), ("c", False)]


def test_evidence_and_audit(spark, tmp_path):
    d = spark.createDataFrame([("s", "https://h/x", AT, 200, bytearray(b"whole"), bytearray(b"part"), 1), ("s", "https://h/x?2", AT, 200, bytearray(b"two"), None, 2)], "source_id string, url string, fetched_at timestamp, http_status int, body binary, stored binary, page int")
    m = {r.path: r for r in store.write_evidence(d, str(tmp_path)).collect()}
    base = "manifests/evidence/s/2026-07-01T06-00-00Z"
    assert set(m) == {f"{base}.meta.json", f"{base}.p2.meta.json"} and m[f"{base}.meta.json"].sha256_stored != m[f"{base}.meta.json"].sha256_full and m[f"{base}.p2.meta.json"].sha256_stored is None
    assert {(r.path, bytes(r.body)) for r in spark.read.parquet(str(tmp_path / "evidence")).collect()} == {(base, b"part"), (f"{base}.p2", b"two")}
    assert spark.read.parquet(str(tmp_path / "manifests")).count() == 2
    row = {"source_id": "s", "url": "u", "status": 200, "attempt": 1}
    for log in ([row], [], [row]):
        store.append_audit(spark, log, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).count() == 2
    x = spark.createDataFrame([("a", "modified", "z", "f"), ("a", "added", "b", "f"), ("a", "removed", "a", "f"), ("a", "added", "B", "f")], "source_id string, delta_kind string, subject string, field_path string")
    assert [r.subject for r in K.delta_order(x).collect()] == ["B", "b", "a", "z"]


def test_registry_lookups(spark):
    s = spark.createDataFrame([("a", "https://H.x/1", "GET", False), ("b", "https://h.x/2", "GET", None), ("c", "https://h.x/3", None, False), ("d", "https://y.x/1", "GET", True), ("e", "https://y.x/2", "GET", False)], "source_id string, url string, method string, excluded boolean")
    assert [tuple(r) for r in registry.hosts_to_sources(s).collect()] == [("h.x", ["a", "b"])]
    m = spark.createDataFrame([("manifests/evidence/src-1/x.meta.json", "src-1"), ("manifests/evidence/x.meta.json", None), ("other/evidence/a/x.meta.json", None)], "p string, w string")
    assert all(r.g == r.w for r in m.select(registry.source_of_manifest(F.col("p")).alias("g"), "w").collect())
    e = spark.createDataFrame([("a", {"x": ["1"], "y": ["2"]}), ("b", {"y": []}), ("c", {"z": ["1"]}), ("d", None)], "canonical_id string, aliases map<string,array<string>>")
    assert {tuple(r) for r in registry.provider_of_entries(e, [("x", "px"), ("y", "py")]).collect()} == {("a", "px"), ("b", "py"), ("c", None), ("d", None)}
    side = spark.createDataFrame([("s", "k", "n1"), ("s", "k", "n0")], "source_id string, subject string, name string")
    d = spark.createDataFrame([("s", "k"), ("s", "q"), (None, "k")], "source_id string, subject string")
    assert {tuple(r) for r in registry.with_sidecar(d, side, ["source_id", "subject"]).collect()} == {("s", "k", "n0"), ("s", "q", None), (None, "k", None)}


def test_price_list_evidence(spark):
    term = {"t": {"effectiveDate": "2026", "priceDimensions": {"d": {"unit": "1K tokens", "pricePerUnit": {"USD": "1"}}}}}
    body = {"offerCode": "o", "products": {"B": {"attributes": {"model": "m", "inferenceType": "Input tokens"}}, "A": {"attributes": {"inferenceType": "Images"}}, "\"q": {"attributes": {"model": "n", "inferenceType": "output  tokens"}}}, "terms": {"OnDemand": {"A": term, "B": term}, "Reserved": {"B": term}}}
    d = spark.createDataFrame([("s", json.dumps(body)), ("t", None), ("u", "{")], "source_id string, payload string")
    out = {r.source_id: r for r in normalize.truncated(d, "consumed-products").collect()}
    got = json.loads(out["s"].payload)
    assert list(got["products"]) == ["\"q", "B"] and got["terms"] == {"OnDemand": {"B": term}} and got["offerCode"] == "o" and out["t"].payload is None and out["s"].truncation_rule == "consumed-products"
    rows = lambda x: {tuple(r) for r in normalize.price_list(x).collect()}
    assert rows(normalize.pruned_price_list(d)) == rows(d.where("source_id = 's'")) != set()
    with pytest.raises(KeyError):
        normalize.truncated(d, "none")


def test_headers_and_heartbeat():
    s = {"source_id": "a", "auth": "none"}
    assert fetch.header_faults(s, "bot", {"User-Agent": "bot"}) == [] and fetch.header_faults(s, "bot", {"user-agent": "other", "Authorization": "x"}) == ["user-agent", "credential authorization"]
    assert fetch.header_faults({"auth": "api-key"}, "bot", {"X-Api-Key": "k"}) == [] and fetch.header_faults({"auth": "api-key", "never_authenticate": True}, "bot", {"X-Api-Key": "k"}) == ["credential x-api-key"]
    said = []
    post = lambda url, t: said.append(url) or 200
    assert fetch.heartbeat(True, None, post) == "skipped" and fetch.heartbeat(True, "http://h", post) == "refused" and fetch.heartbeat(False, "https://h/p/", post) == "sent" and said == ["https://h/p/fail"]
    assert fetch.heartbeat(True, "https://h", lambda *a: 1 / 0) == "failed"
