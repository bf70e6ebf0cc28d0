"""Queries of decoders, normalizers, pages, chains and requests, on payloads made of the given tables, and their SQL.

A payload is made of a row by the same rule in the SQL, which computes what must come out without making the payload.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronodiff.functions import identity as I
from chronodiff.functions import urls as U
from chronodiff.operators import events, fold
from chronodiff.session import prepare
from chronodiff.sources import bodies, normalize, pages, registry, store


def _read(spark: SparkSession, d: str, t: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{d}/{t}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def price_list_rows(spark, d):
    """Each part as a price list of its own: two products, three terms, two of them priced by tokens."""
    k = F.col("p_partkey")
    attrs = lambda model, region: F.format_string('{"attributes":{"inferenceType":"%s","model":"M %d","provider":"Some Co","regionCode":"%s"}}', F.when(k % 2 == 0, "Input  tokens").otherwise("output tokens batch"), model, region)
    term = lambda at, usd, unit: F.format_string('{"t":{"effectiveDate":"%s","priceDimensions":{"d":{"unit":"%s","pricePerUnit":{"USD":"%s"}}}}}', F.lit(at), F.lit(unit), usd)
    size = F.col("p_size")
    body = F.concat(F.lit('{"products":{"A":'), attrs(k % 7, F.lit("r1")), F.lit(',"B":'), attrs(k % 7, F.lit("r1")), F.lit(',"C":'), attrs(k % 7, F.when(k % 3 == 0, "").otherwise("r2")), F.lit('},"terms":{"OnDemand":{"A":'), term("2026-01-01", _text(size), "1K tokens"),
                    F.lit(',"B":'), term("2026-02-01", _text(size + 1), "1M tokens"), F.lit(',"C":'), term("2026-01-01", _text(size + 2), "Hours"), F.lit("}}}"))
    p = _read(spark, d, "part").select(_text(k).alias("source_id"), body.alias("payload"))
    return normalize.price_list(p)


def status_atom(spark, d):
    r = F.col("row_id")
    entry = F.concat(F.lit("<feed><entry><id> tag:x,2005:"), F.when(r % 3 == 0, F.concat(F.lit("Incident/"), _text(r))).otherwise(F.concat(F.lit("raw-"), _text(r))), F.lit(" </id><updated>2026-07-01T00:00:00Z</updated><title> T"), _text(r % 10), F.lit(' </title><content type="html">'),
                     F.when(r % 5 == 0, "none").otherwise("&lt;p&gt;&lt;strong&gt; Resolved &lt;/strong&gt; x &lt;strong&gt;Open&lt;/strong&gt;"), F.lit('</content><link rel="alternate" href="https://h.example/'), _text(r), F.lit('"/></entry></feed>'))
    s = _read(spark, d, "statuspage_incidents").select(_text(r).alias("source_id"), entry.alias("payload"))
    return normalize.incident_feed(s).select("source_id", "id", "status", "updated_at", "name", "shortlink")


def status_rss(spark, d):
    r = F.col("row_id")
    item = F.concat(F.lit("<rss><channel><link>https://h.example</link><item><title>"), F.when(r % 2 == 0, "OpenAI  errors").otherwise("Storage"), F.lit("</title><description>"), F.when(r % 3 == 0, "now mitigated").when(r % 3 == 1, "degraded").otherwise("hm"),
                    F.lit("</description><pubDate>Wed, 01 Jul 2026 1"), _text(r % 10), F.lit(":00:00 "), F.when(r % 4 == 0, "Z").when(r % 4 == 2, "+0200").otherwise("GMT"), F.lit("</pubDate>"), F.when(r % 6 == 0, "").otherwise(F.concat(F.lit("<guid>g"), _text(r), F.lit("</guid>"))), F.lit("<link>l"), _text(r), F.lit("</link></item></channel></rss>"))
    s = _read(spark, d, "statuspage_incidents").select(_text(r).alias("source_id"), item.alias("payload"))
    return normalize.news_feed(s).select("source_id", "id", "status", "updated_at", "name", "shortlink")


def health_events(spark, d):
    r = F.col("row_id")
    body = F.concat(F.lit('[{"arn":"a'), _text(r), F.lit('","service":"'), F.when(r % 3 == 0, "s3").otherwise("bedrock"), F.lit('","service_name":"Amazon '), F.when(r % 5 == 0, "Bedrock").otherwise("X"), F.lit('","status":"'), _text(r % 4), F.lit('","date":"'), F.when(r % 7 == 0, "?").otherwise(_text(1782900000 + r)), F.lit('","summary":"[RESOLVED] s'), _text(r), F.lit('"}]'))
    s = _read(spark, d, "statuspage_incidents").select(_text(r).alias("source_id"), body.alias("payload"))
    return normalize.service_events(s, "bedrock").select("source_id", "id", "status", F.array_join("components", "|").alias("components"), "updated_at", "name")


def graph_payloads(spark, d):
    r = F.col("row_id")
    body = F.concat(F.lit('[{"data":1},["ShallowReactive",2],{"unresolved-incidents-p":3,"other":3},{"incidents":4},[5],{"id":6,"status":7,"'), F.when(r % 2 == 0, "updatedAt").otherwise("created_at"), F.lit('":8,"'), F.when(r % 3 == 0, "services").otherwise("impactedServices"), F.lit('":9},"i'), _text(r), F.lit('"," INVESTIGATING ","2026-01-0'), _text(r % 9 + 1), F.lit('",[10,10,11],{"name":12},["Ref",10],"api'), _text(r % 5), F.lit('"]'))
    s = _read(spark, d, "statuspage_incidents").select(_text(r).alias("source_id"), body.alias("payload"))
    return normalize.graph_incidents(s).select("source_id", "id", "status", F.array_join("components", "|").alias("components"), "updated_at")


def page_items(spark, d):
    k = F.col("doc_id")
    html = F.concat(F.lit("<main><h3>A"), _text(k % 4), F.lit("</h3><p>id big-"), _text(k % 6), F.lit(" and</p><h3>B</h3><p>big-"), _text(k % 6), F.lit(" again</p></main>"))
    x = _read(spark, d, "documents").select("doc_id", F.when(k % 10 == 0, F.concat(F.lit("<body><p>plain "), _text(k), F.lit("</p></body>"))).otherwise(html).alias("h"))
    e = pages.extract(x, "doc_id", "h", pages.Rule(levels=(3,), model=r"\bbig-\d"))
    return e.select("doc_id", "field_path", F.get_json_object("value", "$.content_hash").alias("hash"))


def dated_sections(spark, d):
    k = F.col("doc_id")
    html = F.concat(F.lit("<main><p>intro</p><p>July, 2026</p><p>Jul "), _text(k % 9 + 1), F.lit("</p><p>x"), _text(k), F.lit("</p><p>June, 2026</p><p>Jun 1</p><p>y</p><p>z</p></main>"))
    b = pages.page_blocks(_read(spark, d, "documents").select("doc_id", html.alias("h")), "doc_id", "h", pages.Rule("dates"))
    return pages.date_sections(b, "doc_id").select("doc_id", "name", "heading", "text")


def visible_texts(spark, d):
    html = F.concat(F.lit("<body><nav>menu</nav><h1>T "), _text(F.col("doc_id")), F.lit("</h1><script>x()</script><p>a <b>"), _text(F.col("doc_id") % 3), F.lit("</b></p><iframe>i</iframe></body>"))
    return _read(spark, d, "documents").select("doc_id", pages.visible_text(html).alias("text"))


def import_lines(spark, d):
    k = F.col("doc_id")
    t = F.concat(F.lit("import a from './m-"), _text(k % 5), F.lit("';\nimport b from './x'\nnot import\nimport c from \"./y\";\nimport a from './m-"), _text(k % 5), F.lit("';"))
    return pages.imports(_read(spark, d, "documents").select("doc_id", t.alias("t")), "doc_id", "t")


def body_texts(spark, d):
    e = _read(spark, d, "change_events")
    r = F.col("row_id")
    body = F.when(r % 3 == 0, F.encode("data", "UTF-16")).when(r % 3 == 1, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("data", "UTF-8"))).otherwise(F.encode("data", "UTF-8"))
    return e.select("row_id", bodies.json_text(body).alias("text"), bodies.too_large(F.encode("data", "UTF-8"), 20).alias("large"))


def page_merge(spark, d):
    li = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.format_string('{"Items":["%d-%d"],"NextPageLink":null}', "l_orderkey", "l_linenumber").alias("body"))
    whole = li.join(li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("m")).where("n = m"), "l_orderkey", "left_semi")
    return bodies.merged_pages(whole, ["l_orderkey"], "l_linenumber", "body").select("l_orderkey", F.array_join("items", ",").alias("items"))


def page_links_stay(spark, d):
    m = _read(spark, d, "manifests")
    r = F.col("row_id")
    link = F.when(r % 4 == 0, F.concat(F.upper(F.substring("url", 1, 10)), F.expr("substring(url, 11)"), F.lit("?page=2"))).when(r % 4 == 1, F.concat("url", F.lit("/x"))).when(r % 4 == 2, F.replace(F.col("url"), F.lit("https:"), F.lit("http:"))).otherwise(F.lit("no url"))
    return m.select("row_id", U.same_endpoint(F.col("url"), link).alias("stays"))


def redirects(spark, d):
    r = F.col("row_id")
    hops = F.array(F.col("url"), F.when(r % 3 == 0, "https://elsewhere.example/x").otherwise(F.col("url")))
    m = _read(spark, d, "manifests").select("row_id", hops.alias("hops"))
    return registry.redirect_violations(m, "row_id", "hops", _read(spark, d, "sources")).groupBy("row_id", "reason").agg(F.count(F.lit(1)).alias("n"))


def fetched_records(spark, d):
    m = _read(spark, d, "manifests").select("row_id", "source_id", "url", "fetched_at", "http_status", F.encode("sha256_full", "UTF-8").alias("body"), F.when(F.col("row_id") % 2 == 0, F.encode("sha256_full", "UTF-8")).when(F.col("row_id") % 2 == 1, F.encode("path", "UTF-8")).alias("stored"), (F.col("row_id") % 3).cast("int").alias("page"))
    return store.manifest_record(m).select("path", "sha256_full", "sha256_stored")


def latest_validators(spark, d):
    e = _read(spark, d, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("o"), F.col("event_type").alias("v"))
    return store.upsert(e.where("o % 2 = 0"), e.where("o % 2 = 1"), "k", "o")


def ordered_chains(spark, d):
    li = _read(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("seq"), "l_partkey")
    c = store.chains(li, "l_orderkey")
    return c.select("l_orderkey", F.array_join(F.transform("entries", lambda e: F.concat_ws(":", e["seq"].cast("string"), e["l_partkey"].cast("string"))), ",").alias("entries"))


def chain_flags(spark, d):
    e = _read(spark, d, "events").select(F.col("user_id").alias("event_id"), F.col("event_type").alias("kind"))
    return fold.flags(e, {"bought": "purchase", "failed": "error", "never": "none"})


def event_texts(spark, d):
    t = F.col("text")
    return _read(spark, d, "documents").where(t.isNotNull()).select("doc_id", F.sha2(events.summary(t), 256).alias("summary"), I.file_time(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("file"), I.slug(t, None, "unknown").alias("slug"))


SOURCES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (price_list_rows, status_atom, status_rss, health_events, graph_payloads, page_items, dated_sections, visible_texts, import_lines, body_texts, page_merge, page_links_stay, redirects, fetched_records, latest_validators, ordered_chains, chain_flags, event_texts)
}

SOURCE_SQL: dict[str, str] = {
    "price_list_rows": """
SELECT CAST(p_partkey AS VARCHAR) AS source_id, 'some-co/m-' || (p_partkey % 7) AS model_ref, CASE WHEN p_partkey % 2 = 0 THEN 'input' ELSE 'output' END AS direction, CASE WHEN p_partkey % 2 = 0 THEN 'standard' ELSE 'batch' END AS tier, 'r1' AS region, CAST(p_size + 1 AS DOUBLE) AS value FROM part
""",
    "status_atom": """
SELECT CAST(row_id AS VARCHAR) AS source_id, CASE WHEN row_id % 3 = 0 THEN CAST(row_id AS VARCHAR) ELSE 'tag:x,2005:raw-' || row_id END AS id, 'resolved' AS status, '2026-07-01T00:00:00Z' AS updated_at, 'T' || (row_id % 10) AS name, 'https://h.example/' || row_id AS shortlink FROM statuspage_incidents WHERE row_id % 5 <> 0
""",
    "status_rss": """
SELECT CAST(row_id AS VARCHAR) AS source_id, CASE WHEN row_id % 6 = 0 THEN 'l' ELSE 'g' END || row_id AS id, CASE row_id % 3 WHEN 0 THEN 'resolved' WHEN 1 THEN 'identified' ELSE 'active' END AS status,
 strftime(TIMESTAMP '2026-07-01 10:00:00' + to_hours(CAST(row_id % 10 - CASE WHEN row_id % 4 = 2 THEN 2 ELSE 0 END AS INT)), '%Y-%m-%dT%H:%M:%SZ') AS updated_at, 'OpenAI errors' AS name, 'l' || row_id AS shortlink FROM statuspage_incidents WHERE row_id % 2 = 0
""",
    "health_events": """
SELECT CAST(row_id AS VARCHAR) AS source_id, 'a' || row_id AS id, CASE row_id % 4 WHEN 0 THEN 'resolved' WHEN 1 THEN 'open' ELSE 'status-' || (row_id % 4) END AS status, 'Amazon ' || CASE WHEN row_id % 5 = 0 THEN 'Bedrock' ELSE 'X' END AS components,
 strftime(make_timestamp((1782900000 + row_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS updated_at, 's' || row_id AS name FROM statuspage_incidents WHERE (row_id % 3 <> 0 OR row_id % 5 = 0) AND row_id % 7 <> 0
""",
    "graph_payloads": """
SELECT CAST(row_id AS VARCHAR) AS source_id, 'i' || row_id AS id, 'investigating' AS status, 'api' || (row_id % 5) AS components, '2026-01-0' || (row_id % 9 + 1) AS updated_at FROM statuspage_incidents
""",
    "page_items": """
SELECT doc_id, 'models[big-' || (doc_id % 6) || ']' AS field_path, substr(sha256('id big-' || (doc_id % 6) || ' and'), 1, 16) AS hash FROM documents WHERE doc_id % 10 <> 0
UNION ALL SELECT doc_id, 'sections[b]', substr(sha256('big-' || (doc_id % 6) || ' again'), 1, 16) FROM documents WHERE doc_id % 10 <> 0
UNION ALL SELECT doc_id, 'page[text-hash]', substr(sha256('plain ' || doc_id), 1, 16) FROM documents WHERE doc_id % 10 = 0
""",
    "dated_sections": r"""
SELECT doc_id, 'july-2026/jul-' || (doc_id % 9 + 1) AS name, 'July, 2026 Jul ' || (doc_id % 9 + 1) AS heading, 'x' || doc_id AS text FROM documents UNION ALL SELECT doc_id, 'june-2026/jun-1', 'June, 2026 Jun 1', E'y\nz' FROM documents
""",
    "visible_texts": r"SELECT doc_id, 'T ' || doc_id || E'\na\n' || (doc_id % 3) AS text FROM documents",
    "import_lines": "SELECT doc_id, unnest(['m-' || (doc_id % 5), 'x']) AS model FROM documents",
    "body_texts": "SELECT row_id, data AS text, octet_length(encode(data)) > 20 AS large FROM change_events",
    "page_merge": """
WITH n AS (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = max(l_linenumber)) SELECT l_orderkey, string_agg(l_orderkey || '-' || l_linenumber, ',' ORDER BY l_linenumber) AS items FROM lineitem JOIN n USING (l_orderkey) GROUP BY l_orderkey
""",
    "page_links_stay": "SELECT row_id, row_id % 4 = 0 AS stays FROM manifests",
    "redirects": r"""
WITH s AS (SELECT lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1)) AS host, bool_or(excluded) AS x FROM sources GROUP BY 1), h AS (SELECT row_id, lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1)) AS host FROM manifests UNION ALL SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 'elsewhere.example' ELSE lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1)) END FROM manifests)
SELECT row_id, CASE WHEN x IS NULL THEN 'unregistered host' ELSE 'excluded host' END AS reason, count(*) AS n FROM h LEFT JOIN s USING (host) WHERE x IS NULL OR x GROUP BY ALL
""",
    "fetched_records": """
SELECT 'manifests/evidence/' || source_id || '/' || strftime(fetched_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H-%M-%SZ') || CASE WHEN row_id % 3 > 1 THEN '.p2' ELSE '' END || '.meta.json' AS path, sha256(sha256_full) AS sha256_full, CASE WHEN row_id % 2 = 1 THEN sha256(path) END AS sha256_stored FROM manifests
""",
    "latest_validators": "SELECT user_id AS k, max(event_id) AS o, arg_max(event_type, event_id) AS v FROM events GROUP BY user_id",
    "ordered_chains": "SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS entries FROM lineitem GROUP BY l_orderkey",
    "chain_flags": "SELECT user_id AS event_id, bool_or(event_type = 'purchase') AS bought, bool_or(event_type = 'error') AS failed, false AS never FROM events GROUP BY user_id",
    "event_texts": """
SELECT doc_id, sha256(CASE WHEN length(text) > 280 THEN substr(text, 1, 279) || '…' ELSE text END) AS summary, strftime(published_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H-%M-%SZ') AS file, coalesce(nullif(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unknown') AS slug FROM documents WHERE text IS NOT NULL
""",
}
