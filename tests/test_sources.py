"""Bodies, normalizers, pages, registries and the store, on rows of the shapes that sources deliver."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronodiff.sources import bodies, normalize, pages, registry, store


def payload(spark, v, source="s"):
    return spark.createDataFrame([(source, v if isinstance(v, str) else json.dumps(v))], "source_id string, payload string")


def test_bodies(spark):
    data = [('{"a": "é"}'.encode("utf-16"), "é"), (b'\xef\xbb\xbf{"a": "x"}', "x"), (b'{"a": "y"}', "y")]
    d = spark.createDataFrame([(bytearray(b), w) for b, w in data], "b binary, w string")
    assert all(r.g == r.w for r in d.select(F.get_json_object(bodies.json_text(F.col("b")), "$.a").alias("g"), "w").collect())
    bad = spark.createDataFrame([(bytearray(b"a\xffb"),)], "b binary").select(bodies.text(F.col("b")).alias("t"), bodies.too_large(F.col("b"), 2).alias("l")).first()
    assert bad.t == "a�b" and bad.l


def test_pages_merge_whole_or_not_at_all(spark):
    page = lambda *x: json.dumps({"Items": [{"n": i} for i in x]})
    d = spark.createDataFrame([("r", 2, page(3)), ("r", 1, page(1, 2))], "run string, p int, body string")
    out = bodies.merged_pages(d, ["run"], "p", "body").first()
    assert [json.loads(x)["n"] for x in out["items"]] == [1, 2, 3]
    for rows, most in (([("r", 2, page(1))], 40), ([("r", 1, "{")], 40), ([("r", 1, page(1)), ("r", 2, page(2))], 1)):
        with pytest.raises(PySparkException):
            bodies.merged_pages(spark.createDataFrame(rows, "run string, p int, body string"), ["run"], "p", "body", most).collect()


def test_trees(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x":\n1}')
    (tmp_path / "b.jsonl").write_text('{"y":1}\n\n{"y":2}\n')
    (tmp_path / "c.bin").write_bytes(b"a\x00b")
    (tmp_path / ".git").mkdir()
    (tmp_path / ".git" / "d.txt").write_text("hidden")
    assert {(r.path.rsplit("/", 1)[1], r.line) for r in bodies.tree_texts(spark, str(tmp_path)).collect()} == {("a.json", None), ("b.jsonl", 1), ("b.jsonl", 3)}
    assert {r.path.rsplit("/", 1)[1] for r in bodies.text_files(spark, str(tmp_path)).collect()} == {"a.json", "b.jsonl"}


def test_models(spark):
    v = {"data": [{"id": "a/b", "created": 5, "context_length": 10.0, "architecture": {"input_modalities": ["text", "image"], "output_modalities": ["text"]}}, {"id": None}, {"id": "c", "created": True, "context_length": "x"}, {"created": 1}]}
    out = {r.id: (r.created, r.context_window, r.modalities, r.owned_by, r.endpoints) for r in normalize.models(payload(spark, v)).collect()}
    assert out == {"a/b": (5, 10, ["image", "text"], None, []), "c": (None, None, [], None, [])}


def test_token_price_map(spark):
    v = {"sample_spec": {"input_cost_per_token": 1}, "m": {"input_cost_per_token": 1.25e-6, "cache_read_input_token_cost": 1e-7, "output_cost_per_token": "x", "mode": "chat"}}
    assert {(r.model_ref, r.direction, r.tier, r.value) for r in normalize.token_price_map(payload(spark, v)).collect()} == {("m", "input", "standard", 1.25), ("m", "input", "cached_read", 0.1)}


def test_incidents(spark):
    v = {"incidents": [{"id": "1", "status": "open", "updated_at": "t", "components": [{"name": "b"}, {"name": "a"}, {"name": "b"}, {}], "impact": "minor"}, {"id": "2", "status": None, "updated_at": "t"}]}
    assert [(r.id, r.components, r.impact) for r in normalize.incidents(payload(spark, v)).collect()] == [("1", ["a", "b"], "minor")]


def test_feeds(spark):
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>tag:x,2005:Incident/77</id><updated>2026-07-01T00:00:00Z</updated><title> T </title><content type="html">&lt;strong&gt;Resolved&lt;/strong&gt; - ok &lt;strong&gt;Open&lt;/strong&gt;</content><link rel="alternate" href="https://h/77"/></entry><entry><id>raw</id><updated>u</updated><content type="html">none</content></entry></feed>'
    assert [(r.id, r.status, r.name, r.shortlink) for r in normalize.incident_feed(payload(spark, atom)).collect()] == [("77", "resolved", "T", "https://h/77")]
    rss = "<rss><channel><link>https://h</link><item><title>OpenAI  errors</title><description>now mitigated</description><pubDate>Wed, 01 Jul 2026 10:00:00 Z</pubDate><guid>g1</guid><link>l1</link></item><item><title>Storage</title><description>degraded</description><pubDate>Wed, 01 Jul 2026 10:00:00 GMT</pubDate><guid>g2</guid></item><item><title>AI Foundry is slow</title><pubDate>Wed, 01 Jul 2026 12:00:00 +0200</pubDate><link>l3</link></item></channel></rss>"
    assert {(r.id, r.status, r.updated_at, r.name) for r in normalize.news_feed(payload(spark, rss)).collect()} == {("g1", "resolved", "2026-07-01T10:00:00Z", "OpenAI errors"), ("l3", "active", "2026-07-01T10:00:00Z", "AI Foundry is slow")}


def test_service_events(spark):
    v = [{"arn": "a", "service": "bedrock", "status": "1", "date": "1782900000", "summary": "[RESOLVED] x", "service_name": "B"}, {"arn": "b", "service": "s3", "status": "1", "date": "1"}, {"arn": "c", "service_name": "Amazon Bedrock", "status": 3, "date": 0}, {"arn": "d", "service": "bedrock", "status": "0", "date": "?"}]
    assert {(r.id, r.status, r.updated_at, r.name) for r in normalize.service_events(payload(spark, v), "bedrock").collect()} == {("a", "open", "2026-07-01T10:00:00Z", "x"), ("c", "status-3", "1970-01-01T00:00:00Z", None)}


def test_graph(spark):
    flat = [{"data": 1}, ["ShallowReactive", 2], {"unresolved-incidents-p": 3, "other": 3}, {"incidents": 4}, [5], {"id": 6, "status": 7, "createdAt": 8, "services": 9}, "i1", " INVESTIGATING ", "2026-01-01", [10, 10], {"name": 11}, "api"]
    assert [(r.id, r.status, r.updated_at, r.components) for r in normalize.graph_incidents(payload(spark, flat)).collect()] == [("i1", "investigating", "2026-01-01", ["api"])]
    assert normalize.unflattened([[0]]) == [None] and normalize.graph_incidents(payload(spark, "[]")).count() == 0


def test_unflattened():
    f = normalize.unflattened
    assert f([{"a": 1, "b": [9], "c": True}, [2, 2, 3], "x", ["Ref", 2]]) == {"a": ["x", "x", "x"]}
    assert f([{"self": 0, "gone": 7, "loop": 1}, ["Ref", 2], ["Ref", 1]]) == {"self": None, "gone": None, "loop": None}
    assert f([]) is None and f(["Ref", 1]) == "Ref" and f([["Ref", 1], 5]) == 5 and f([{"u": -1}]) == {"u": None}
    deep = [[i + 1] for i in range(5000)] + ["end"]
    v = f(deep)
    for _ in range(5000):
        v = v[0]
    assert v == "end"


def test_blocks():
    b = lambda h, *roots: pages.blocks(h, roots)
    assert b("<main><h2>A\ue000 b</h2><iframe>z</iframe><template><p>c</p></template><button>d</button></main>", "main") == [(2, "A b"), (0, "c\nd")]
    assert b("<body><article></article><main>x</main></body>", "article", "main") == [(0, "x")] and b("<body>y</body>", "main") == [(0, "y")] and b(None) == []
    assert b("<main>a<main>b</main>c</main>d<main>e<h3>lost</main>", "main") == [(0, "a\nb\nc"), (0, "e")]
    assert b("<div class='x doc-1'>a<nav><nav>m</nav>n</nav><h1>t</h1></div>", ".doc") == [(0, "a"), (1, "t")]


def test_price_list(spark):
    term = lambda at, usd, unit="1K tokens": {"t": {"effectiveDate": at, "priceDimensions": {"d": {"unit": unit, "pricePerUnit": {"USD": usd}}}}}
    attrs = {"inferenceType": "Input  tokens", "model": "Big Model 2", "provider": "Some Co", "regionCode": "r1"}
    v = {"products": {"B": {"attributes": attrs}, "A": {"attributes": attrs}, "C": {"attributes": {**attrs, "inferenceType": "Images"}}, "D": {"attributes": {**attrs, "provider": "", "regionCode": None}}},
         "terms": {"OnDemand": {"B": term("2026-01-01", "0.002"), "A": term("2026-01-01", "0.001"), "C": term("x", "1"), "D": term("2026", "3", "1M tokens")}}}
    assert {(r.model_ref, r.direction, r.tier, r.region, r.value) for r in normalize.price_list(payload(spark, v)).collect()} == {("some-co/big-model-2", "input", "standard", "r1", 1.0), ("amazon/big-model-2", "input", "standard", "global", 3.0)}


def test_retail_prices(spark):
    item = lambda name, price, **k: {"currencyCode": "USD", "type": "Consumption", "unitOfMeasure": "1K", "meterName": name, "meterId": "m", "retailPrice": price, "armRegionName": "r", "effectiveStartDate": "2026", "isPrimaryMeterRegion": False, **k}
    v = {"Items": [item("gpt x Inp glbl Tokens", 0.001), item("gpt x Inp glbl Tokens", 0.002, isPrimaryMeterRegion=True), item("gpt x Opt Tokens", 1.0), item("gpt x Inp Batch Cached Tokens", 1.0), item("gpt x Outp Batch 1M Tokens", 2.0, unitOfMeasure="1M", armRegionName=""), item("gpt x Inp", 1.0), item("Inp Tokens", 1.0)]}
    assert {(r.model_ref, r.direction, r.tier, r.region, r.value) for r in normalize.retail_prices(payload(spark, v)).collect()} == {("gpt-x-global", "input", "standard", "r", 2.0), ("gpt-x", "output", "batch", "global", 2.0)}


HTML = "<html><body><nav>menu</nav><article><h1>Top</h1><p>before</p><h2>July &amp; more</h2><p>a <b>b</b></p><script>x</script><h3>Part</h3><ul><li>c<li>d</ul><h2>July &amp; more</h2><p>e</p><h1>Other</h1><p>f</p></article><footer>z</footer></body></html>"


def sections(spark, html, rule):
    b = pages.page_blocks(spark.createDataFrame([(1, html)], "k bigint, h string"), "k", "h", rule)
    s = pages.date_sections(b, "k") if rule.kind == "dates" else pages.heading_sections(b, "k", rule)
    return [(r.name, r.heading, r.text) for r in s.orderBy("n").collect()]


def test_sections(spark):
    assert sections(spark, HTML, pages.Rule()) == [("july-more", "July & more", "a\nb"), ("part", "Part", "c\nd"), ("july-more-2", "July & more", "e")]
    assert [x[0] for x in sections(spark, HTML, pages.Rule(hierarchical=True))] == ["july-more", "july-more/part", "july-more-2"]
    dates = "<main><p>intro</p><p>July, 2026</p><p>Jul 8</p><p>x</p><p>Jul 7</p><p>y</p><p>June, 2026</p><p>Jun 1</p></main>"
    assert sections(spark, dates, pages.Rule("dates")) == [("july-2026/jul-8", "July, 2026 Jul 8", "x"), ("july-2026/jul-7", "July, 2026 Jul 7", "y"), ("june-2026/jun-1", "June, 2026 Jun 1", "")]


def test_extract(spark):
    d = spark.createDataFrame([(1, "<main><h3>A</h3><p>id big-1 and big-2</p><h3>B</h3><p>big-1 again</p></main>"), (2, "<p>plain</p>"), (3, None)], "k bigint, h string")
    out = {(r.k, r.field_path) for r in pages.extract(d, "k", "h", pages.Rule(levels=(3,), model=r"\bbig-\d")).collect()}
    assert out == {(1, "models[big-1]"), (1, "sections[b]"), (2, "page[text-hash]"), (3, "page[text-hash]")}
    t = spark.createDataFrame([(1, "import a from './x-1';\nimport b from './x-1'\nfoo\nimport c from './y';")], "k bigint, h string")
    assert {r.field_path for r in pages.extract(t, "k", "h", pages.Rule("imports")).collect()} == {"models[x-1]", "models[y]"}


def test_links_and_parity(spark):
    d = spark.createDataFrame([("<a href='/b#x'>1</a><a href='c'>2</a><a href='https://other/d'>3</a><a href='https://H.example/b'>4</a><a>5</a>", "https://h.example/a/")], "h string, u string")
    assert d.select(pages.same_host_paths("h", "u").alias("p")).first().p == ["/a/c", "/b"]
    t = spark.createDataFrame([(1, "has m1 and m2")], "k bigint, t string")
    m = spark.createDataFrame([(1, "m1"), (1, "m3"), (1, "m2")], "k bigint, m string")
    r = pages.parity(t, "k", "t", m, "m").first()
    assert (r.found, r.listed, r.ratio, r.ok) == (2, 3, 0.6667, True)


def test_registry(spark):
    doc = spark.createDataFrame([([("a", "https://A.example/x"), ("b", "https://b.example/y")],)], "sources array<struct<source_id string, url string>>")
    s = registry.sources_of(doc)
    assert {r.source_id for r in s.collect()} == {"a", "b"}
    with pytest.raises(PySparkException):
        registry.sources_of(spark.createDataFrame([([("a", "u"), ("a", "v")],)], "sources array<struct<source_id string, url string>>")).collect()
    x = s.withColumn("excluded", F.col("source_id") == "b")
    hops = spark.createDataFrame([("k", ["https://a.example/1", "https://b.example/2", "https://c.example/3"])], "k string, hops array<string>")
    assert {(r.hop[-1], r.reason) for r in registry.redirect_violations(hops, "k", "hops", x).collect()} == {("2", "excluded host"), ("3", "unregistered host")}


def test_store(spark, tmp_path):
    new = lambda *x: spark.createDataFrame(list(x), "id string, v int")
    p = str(tmp_path / "t")
    assert store.insert_absent(new(("a", 1), ("a", 1), ("b", 2)), p, "id").count() == 2
    store.insert_absent(new(("b", 9), ("c", 3)), p, "id")
    assert {tuple(r) for r in spark.read.parquet(p).collect()} == {("a", 1), ("b", 2), ("c", 3)}
    chain = spark.createDataFrame([("a", 1), ("a", 2)], "k string, seq bigint")
    assert {tuple(r) for r in store.next_seq(spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "w")], "k string, t string"), chain, "k", ["t"]).collect()} == {("a", "w", 3), ("a", "x", 4), ("b", "y", 1)}
    root = str(tmp_path / "runs")
    store.publish_run({"snap": new(("a", 1))}, root, "r1")
    new(("b", 2)).withColumn("run_id", F.lit("r2")).write.parquet(f"{root}/snap/run_id=r2")
    assert [r.id for r in store.published(spark, root, "snap").collect()] == ["a"]
    m = spark.createDataFrame([("m/x",), ("../x",), ("/abs",), ("gone",)], "p string")
    have = spark.createDataFrame([("m/x",), ("../x",), ("/abs",)], "path string")
    assert [r.p for r in store.existing_manifests(m, "p", have).collect()] == ["m/x"]
