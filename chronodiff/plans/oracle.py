"""SQL that gives the same rows as the queries of the core on the same tables, in DuckDB's dialect."""

from __future__ import annotations

_WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

_MODELS = """
WITH p AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS id, p_brand AS owned_by, p_type AS ep, p_size AS cw FROM part),
o AS (SELECT * FROM p WHERE k % 10 <> 0),
n AS (SELECT k, id, CASE WHEN k % 11 = 0 THEN 'other' ELSE owned_by END AS owned_by, CASE WHEN k % 13 = 0 THEN 'new' ELSE ep END AS ep, cw + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS cw FROM p WHERE k % 10 <> 1),
j AS (SELECT coalesce(o.id, n.id) AS id, o.id AS oi, n.id AS ni, o.owned_by AS oo, n.owned_by AS no, o.ep AS oe, n.ep AS ne, o.cw AS oc, n.cw AS nc FROM o FULL OUTER JOIN n ON o.id = n.id)
SELECT 'model.released' AS event_type, 'models[].id' AS field_path, 'added' AS delta_kind, id AS subject, CAST(NULL AS VARCHAR) AS old, id AS "new" FROM j WHERE oi IS NULL
UNION ALL SELECT 'model.deprecated', 'models[].id', 'removed', id, id, NULL FROM j WHERE ni IS NULL
UNION ALL SELECT 'limits.changed', 'models[].context_window', 'modified', id, CAST(oc AS VARCHAR), CAST(nc AS VARCHAR) FROM j WHERE oi IS NOT NULL AND ni IS NOT NULL AND oc IS DISTINCT FROM nc
UNION ALL SELECT 'capability.changed', 'models[].endpoints', 'modified', id, '["' || oe || '"]', '["' || ne || '"]' FROM j WHERE oi IS NOT NULL AND ni IS NOT NULL AND oe IS DISTINCT FROM ne
UNION ALL SELECT NULL, 'models[].owned_by', 'modified', id, oo, no FROM j WHERE oi IS NOT NULL AND ni IS NOT NULL AND oo IS DISTINCT FROM no
"""

_PRICES = """
WITH p AS (SELECT p_partkey AS k, p_brand AS model_ref, CASE WHEN p_partkey % 2 = 0 THEN 'input' ELSE 'output' END AS direction, CASE WHEN p_partkey % 3 = 0 THEN 'batch' ELSE 'standard' END AS tier, round(p_retailprice, 2) AS value FROM part),
o AS (SELECT * FROM p WHERE k % 10 <> 0),
n AS (SELECT k, model_ref, direction, tier, CASE WHEN k % 7 = 0 THEN round(value * 2, 2) ELSE value END AS value FROM p WHERE k % 10 <> 1),
j AS (SELECT coalesce(o.k, n.k) AS k, coalesce(o.model_ref, n.model_ref) AS model_ref, coalesce(o.direction, n.direction) AS direction, coalesce(o.tier, n.tier) AS tier, o.k AS ok, n.k AS nk, o.value AS ov, n.value AS nv FROM o FULL OUTER JOIN n ON o.k = n.k)
"""

_CHAIN = """
WITH c AS (SELECT user_id AS event_id, ts, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'confirm' WHEN 'error' THEN 'reject' WHEN 'signup' THEN 'discrepancy' ELSE event_type END AS kind,
 CASE WHEN event_type IN ('purchase', 'error') THEN 1 ELSE 0 END AS rank, CASE event_type WHEN 'purchase' THEN 'confirmed' WHEN 'error' THEN 'rejected' END AS dec FROM events)
"""

_FOLD = """
f AS (SELECT event_id, coalesce(arg_max(dec, row(ts, rank, seq)) FILTER (WHERE dec IS NOT NULL), 'unconfirmed') AS status,
 coalesce(max(row(ts, rank, seq)) FILTER (WHERE kind = 'discrepancy') > max(row(ts, rank, seq)) FILTER (WHERE dec IS NOT NULL), count(*) FILTER (WHERE kind = 'discrepancy') > 0) AS discrepancy_open FROM c GROUP BY event_id)
"""

# Unit words of amounts: factor and whether they are a word for tokens.
_UNIT = """
u(word, factor, thing) AS (VALUES ('', 1, ''), ('k', 1000, ''), ('thousand', 1000, ''), ('m', 1000000, ''), ('mio', 1000000, ''), ('million', 1000000, ''), ('token', 1, 't'), ('tokens', 1, 't'), ('tok', 1, 't'), ('mtok', 1000000, 't'), ('mtokens', 1000000, 't'))
"""


def _counted(source: str) -> str:
    """Adds cnt (tokens per price) to rows of ``source`` (row_id, amount, cents, unit): amount for ``unit`` tidy text without money."""
    return f"""
 x AS (SELECT *, regexp_extract(unit, '^([\\d.,]*)(?:\\^(\\d+))?\\s*([a-z]*)\\.?\\s*([a-z]*)$', ['n', 'p', 'a', 'b']) AS g, regexp_matches(unit, '^([\\d.,]*)(?:\\^(\\d+))?\\s*([a-z]*)\\.?\\s*([a-z]*)$') AS ok FROM {source}),
 y AS (SELECT x.row_id, x.amount, x.cents, (CASE WHEN g.p <> '' THEN CAST(pow(CAST(g.n AS DOUBLE), CAST(g.p AS DOUBLE)) AS DECIMAL(18, 4)) WHEN g.n = '' THEN 1 ELSE TRY_CAST(replace(g.n, ',', '') AS DECIMAL(18, 4)) END) * a.factor * b.factor AS cnt
 FROM x JOIN u a ON a.word = g.a JOIN u b ON b.word = g.b WHERE ok AND NOT (a.thing = 't' AND b.thing = 't'))"""


_PROMPT = r"""
 m0 AS (SELECT row_id, lower(trim(pricing.prompt, E' \t\n')) AS t FROM openrouter_models),
 m1 AS (SELECT row_id, t, regexp_matches(t, '^[-+]?[\d.]+(e[-+]?\d+)?$') AS bare FROM m0 WHERE t <> ''),
 m2 AS (SELECT row_id, CASE WHEN bare THEN CAST(CAST(t AS DOUBLE) AS DECIMAL(24, 14)) ELSE CAST(replace(regexp_extract(t, '(\d[\d.,]*)', 1), ',', '.') AS DECIMAL(24, 14)) END AS amount,
  regexp_matches(t, '¢|cent') AS cents, CASE WHEN bare THEN '1' ELSE trim(regexp_extract(t, '^[^\d]*[\d.,]+\s*(?:cents?|¢|usd|\$)?\s*(?:/|per|je)\s*(.*)$', 1)) END AS unit FROM m1),
 m AS (SELECT * FROM m2 WHERE amount >= 0)"""

_AZURE = r"""
 a0 AS (SELECT row_id, retail_price, lower(trim(coalesce(unit_of_measure, ''))) AS uom, regexp_replace(lower(coalesce(meter_name, '')), '[\s\x{A0}_]+', ' ', 'g') AS nm FROM azure_retail_prices WHERE lower(currency_code) = 'usd' AND retail_price IS NOT NULL),
 a1 AS (SELECT row_id, retail_price, CASE WHEN uom NOT IN ('', 'n/a') THEN uom ELSE regexp_replace(regexp_extract(nm, '\(per [^)]+\)|\bper (?:thousand |million )?tokens?\b|/1[km] tok\b|\b1[km] tokens\b|\bmtok\b'), '^\(?(per |/)|\)$', '', 'g') END AS un FROM a0),
 a AS (SELECT row_id, CAST(retail_price AS DECIMAL(24, 14)) AS amount, regexp_matches(un, '¢|cent') AS cents, trim(regexp_replace(regexp_replace(un, '^(us )?(cents?|¢)\s*', ''), '^(/|per )\s*', '')) AS unit FROM a1 WHERE un <> '')"""

_MICRO = "CAST(round(CAST(amount AS DOUBLE) * CASE WHEN cents THEN 0.01 ELSE 1 END * 1000000000000 / CAST(cnt AS DOUBLE)) AS BIGINT)"

ORACLE: dict[str, str] = {
    "p2_found": f"""
WITH {_UNIT}, {_PROMPT}, {_counted("m")},
 pr AS (SELECT row_id, {_MICRO} AS v FROM y),
 r AS (SELECT 'openrouter_models' AS t, feed_id, snapshot_id, run_ts, id, landed_at, row_id, coalesce(CAST(pr.v AS VARCHAR), 'none') AS v FROM openrouter_models LEFT JOIN pr USING (row_id)
  UNION ALL SELECT 'statuspage_incidents', feed_id, snapshot_id, run_ts, id, landed_at, row_id, coalesce(lower(trim(status, E' \\t\\n')), 'none') FROM statuspage_incidents),
 l AS (SELECT t, feed_id, snapshot_id, max(run_ts) AS run_ts, id, arg_max(v, row(landed_at, row_id)) AS v FROM r GROUP BY t, feed_id, snapshot_id, id),
 s AS (SELECT t, feed_id, snapshot_id, row_number() OVER (PARTITION BY t, feed_id ORDER BY max(run_ts), snapshot_id) AS k FROM l GROUP BY t, feed_id, snapshot_id),
 q AS (SELECT l.t, l.feed_id, l.id, l.v, s.k FROM l JOIN s USING (t, feed_id, snapshot_id)),
 mx AS (SELECT t, feed_id, max(k) AS k FROM s GROUP BY t, feed_id),
 o AS (SELECT q.* FROM q JOIN mx ON q.t = mx.t AND q.feed_id = mx.feed_id AND q.k < mx.k),
 n AS (SELECT * FROM q WHERE k > 1),
 j AS (SELECT coalesce(n.t, o.t) AS t, coalesce(n.feed_id, o.feed_id) AS feed_id, coalesce(n.k, o.k + 1) AS k, coalesce(n.id, o.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN n.v <> o.v THEN 'changed' END AS c
  FROM n FULL OUTER JOIN o ON n.t = o.t AND n.feed_id = o.feed_id AND n.k = o.k + 1 AND n.id = o.id)
SELECT j.t AS record_table, s.snapshot_id, j.id AS record_id, j.c AS change FROM j JOIN s ON s.t = j.t AND s.feed_id = j.feed_id AND s.k = j.k WHERE j.c IS NOT NULL
""",
    "p3_found": """
WITH b0 AS (SELECT row_id, ltrim(body, chr(65279)) AS t FROM bedrock_offers WHERE body IS NOT NULL),
 b1 AS (SELECT row_id, CASE WHEN json_type(t) = 'VARCHAR' THEN t ->> '$' ELSE t END AS t FROM b0 WHERE json_valid(t)),
 b AS (SELECT row_id, CAST(t AS JSON) AS j FROM b1 WHERE json_valid(t) AND json_type(t) = 'OBJECT'),
 po AS (SELECT row_id, coalesce(j ->> '$.offerCode', '') AS offer, unnest(CASE json_type(j -> '$.products') WHEN 'OBJECT' THEN map_values(CAST(j -> '$.products' AS MAP(VARCHAR, JSON))) WHEN 'ARRAY' THEN CAST(j -> '$.products' AS JSON[]) ELSE [] END) AS p FROM b),
 fe AS (SELECT row_id, p ->> '$.sku' AS sku, unnest(CASE WHEN json_type(p -> '$.features') = 'ARRAY' THEN CAST(p -> '$.features' AS JSON[]) ELSE [] END) AS f FROM po),
 kinds AS (SELECT row_id, unnest(map_values(CAST(j -> '$.terms' AS MAP(VARCHAR, JSON)))) AS k FROM b WHERE json_type(j -> '$.terms') = 'OBJECT'),
 skus AS (SELECT row_id, unnest(map_values(CAST(k AS MAP(VARCHAR, JSON)))) AS s FROM kinds),
 inner_kinds AS (SELECT row_id, unnest(map_values(CAST(p -> '$.terms' AS MAP(VARCHAR, JSON)))) AS k FROM po WHERE json_type(p -> '$.terms') = 'OBJECT'),
 t AS (SELECT row_id, unnest(map_values(CAST(s AS MAP(VARCHAR, JSON)))) AS t FROM skus
  UNION ALL SELECT row_id, unnest(CAST(j -> '$.terms' AS JSON[])) FROM b WHERE json_type(j -> '$.terms') = 'ARRAY'
  UNION ALL SELECT row_id, unnest(CAST(k AS JSON[])) FROM inner_kinds WHERE json_type(k) = 'ARRAY'),
 tk AS (SELECT row_id, t, (t ->> '$.sku') AS sku, (t ->> '$.sku') || '.' || (t ->> '$.offerTermCode') AS key FROM t),
 pr AS (SELECT row_id, key AS parent, unnest(map_entries(CAST(t -> '$.priceDimensions' AS MAP(VARCHAR, JSON)))) AS e FROM tk WHERE json_type(t -> '$.priceDimensions') = 'OBJECT'),
 pa AS (SELECT row_id, key AS parent, unnest(CAST(t -> '$.priceDimensions' AS JSON[])) AS e FROM tk WHERE json_type(t -> '$.priceDimensions') = 'ARRAY')
SELECT row_id, 'product' AS level, p ->> '$.sku' AS node_key, offer AS parent_key FROM po
UNION ALL SELECT row_id, 'feature', f ->> '$.name', sku FROM fe
UNION ALL SELECT row_id, 'term', key, sku FROM tk
UNION ALL SELECT row_id, 'price', coalesce(e.value ->> '$.rateCode', e.key), parent FROM pr
UNION ALL SELECT row_id, 'price', e ->> '$.rateCode', parent FROM pa
""",
    "p4_found": """
WITH e AS (SELECT id, arg_min(struct_pack(o := observed_at, l := landed_at, c := correction_of, ev := evidence), row(landed_at, row_id)) AS r FROM change_events WHERE id IS NOT NULL GROUP BY id),
 m AS (SELECT path AS key, arg_min(struct_pack(l := landed_at, d := deleted_at), row(landed_at, row_id)) AS r FROM manifests GROUP BY path),
 x AS (SELECT id, r.o AS o, r.l AS l, unnest(r.ev) AS ev, generate_subscripts(r.ev, 1) - 1 AS pos FROM e),
 refs AS (SELECT id, pos, 'source_id' AS field, ev.source_id AS key, o, l FROM x UNION ALL SELECT id, pos, 'manifest_path', ev.manifest_path, o, l FROM x UNION ALL SELECT id, -1, 'correction_of', r.c, r.o, r.l FROM e),
 t AS (SELECT 'source_id' AS field, source_id AS key, added_at AS a, removed_at AS d FROM sources UNION ALL SELECT 'manifest_path', key, r.l, r.d FROM m UNION ALL SELECT 'correction_of', id, r.l, NULL FROM e),
 k AS (SELECT refs.*, CASE WHEN t.key IS NULL THEN 'missing' WHEN t.a > l THEN 'late' WHEN t.d <= l THEN 'deleted' END AS kind FROM refs LEFT JOIN t ON refs.field = t.field AND refs.key = t.key WHERE refs.key IS NOT NULL)
SELECT id AS event_id, CAST(pos AS BIGINT) AS pos, field, strftime(o AT TIME ZONE 'UTC', '%Y-%m') AS period, kind FROM k WHERE kind IS NOT NULL
""",
    "p5_found": r"""
WITH v AS (SELECT 'openrouter_models' AS t, row_id, 0 AS pos, source_id, created AS x FROM openrouter_models UNION ALL SELECT 'statuspage_incidents', row_id, 0, source_id, created_at FROM statuspage_incidents
  UNION ALL SELECT 'azure_retail_prices', row_id, 0, source_id, effective_start_date FROM azure_retail_prices
  UNION ALL SELECT 'change_events', row_id, pos, e.source_id, e.fetched_at FROM (SELECT row_id, unnest(evidence) AS e, generate_subscripts(evidence, 1) - 1 AS pos FROM change_events)),
 s AS (SELECT v.t, v.row_id, v.pos, coalesce(sources.zone, 'UTC') AS zone, coalesce(date_order, 'mdy') AS o, upper(trim(x, E' \t\n')) AS x FROM v LEFT JOIN sources USING (source_id) WHERE x IS NOT NULL),
 f AS (SELECT *, regexp_extract(x, '^(\d{4})-?(\d{2})-?(\d{2})(?:[T ](\d{2})[:-]?(\d{2})(?:[:-]?(\d{2})(?:\.(\d+))?)?\s*(.*))?$', ['y', 'm', 'd', 'h', 'i', 's', 'f', 'z']) AS a,
  regexp_extract(x, '^(\d{1,2})[/.](\d{1,2})[/.](\d{4})(?: (\d{1,2}):(\d{2})(?::(\d{2}))?(?: (AM|PM))?)?$', ['p', 'q', 'y', 'h', 'i', 's', 'ap']) AS b,
  regexp_extract(x, '^(?:[A-Z]{3}, )?(\d{1,2}) ([A-Z]{3})[A-Z]* (\d{4}),? (\d{2}):(\d{2}):(\d{2}) (.*)$', ['d', 'm', 'y', 'h', 'i', 's', 'z']) AS c,
  regexp_extract(x, '^([A-Z]{3}) (\d{1,2}), (\d{4}) (\d{1,2}):(\d{2}) (AM|PM) (.*)$', ['m', 'd', 'y', 'h', 'i', 'ap', 'z']) AS e FROM s),
 p AS (SELECT t, row_id, pos, zone, CASE WHEN regexp_matches(x, '^\d+(\.\d+)?$') THEN TRY_CAST(x AS DECIMAL(30, 6)) END AS n,
  CASE WHEN a.y <> '' THEN a.y || '-' || a.m || '-' || a.d WHEN b.y <> '' THEN b.y || '-' || CASE WHEN o = 'dmy' THEN b.q || '-' || b.p ELSE b.p || '-' || b.q END
   WHEN c.y <> '' THEN c.y || '-' || CAST((strpos('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', c.m) + 2) // 3 AS VARCHAR) || '-' || c.d WHEN e.y <> '' THEN e.y || '-' || CAST((strpos('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', e.m) + 2) // 3 AS VARCHAR) || '-' || e.d END AS d,
  CASE WHEN a.y <> '' THEN TRY_CAST(nullif(a.h, '') AS INT) WHEN b.y <> '' THEN CASE WHEN b.ap = '' THEN TRY_CAST(nullif(b.h, '') AS INT) ELSE TRY_CAST(b.h AS INT) % 12 + CASE b.ap WHEN 'PM' THEN 12 ELSE 0 END END
   WHEN c.y <> '' THEN TRY_CAST(c.h AS INT) WHEN e.y <> '' THEN TRY_CAST(e.h AS INT) % 12 + CASE e.ap WHEN 'PM' THEN 12 ELSE 0 END END AS h,
  TRY_CAST(nullif(coalesce(nullif(a.i, ''), nullif(b.i, ''), nullif(c.i, ''), nullif(e.i, '')), '') AS INT) AS i, TRY_CAST(coalesce(nullif(a.s, ''), nullif(b.s, ''), nullif(c.s, '')) AS INT) AS sec,
  TRY_CAST(rpad(substr(a.f, 1, 6), 6, '0') AS INT) AS us, coalesce(nullif(a.z, ''), nullif(c.z, ''), nullif(e.z, ''), '') AS z FROM f),
 l AS (SELECT *, TRY_CAST(d AS DATE) AS dd, regexp_replace(z, '[\[\]]', '', 'g') AS zz FROM p),
 k AS (SELECT t, row_id, pos, n, CASE WHEN coalesce(h, 0) < 24 AND coalesce(i, 0) < 60 AND coalesce(sec, 0) < 60 THEN CAST(dd AS TIMESTAMP) + to_hours(coalesce(h, 0)) + to_minutes(coalesce(i, 0)) + to_seconds(coalesce(sec, 0)) + to_microseconds(coalesce(us, 0)) END AS lo,
  CASE WHEN zz = '' THEN zone WHEN contains(zz, '/') THEN (SELECT min(name) FROM pg_timezone_names() WHERE upper(name) = zz) END AS place,
  CASE WHEN regexp_matches(zz, '^[+-]') THEN CASE WHEN zz[1] = '-' THEN -1 ELSE 1 END * (TRY_CAST(zz[2:3] AS INT) * 60 + coalesce(TRY_CAST(nullif(right(replace(zz, ':', ''), -3), '') AS INT), 0))
   ELSE 60 * CASE zz WHEN 'Z' THEN 0 WHEN 'UTC' THEN 0 WHEN 'GMT' THEN 0 WHEN 'PST' THEN -8 WHEN 'PDT' THEN -7 WHEN 'EST' THEN -5 WHEN 'EDT' THEN -4 WHEN 'CET' THEN 1 WHEN 'CEST' THEN 2 WHEN 'JST' THEN 9 END END AS off FROM l),
 r AS (SELECT t, row_id, pos, CASE WHEN n IS NOT NULL THEN CAST(floor(n * CASE WHEN n < 100000000000 THEN 1000000 WHEN n < 100000000000000 THEN 1000 ELSE 1 END) AS BIGINT)
  WHEN place IS NOT NULL THEN CASE WHEN (lo AT TIME ZONE place) AT TIME ZONE place = lo THEN least(epoch_us(lo AT TIME ZONE place), CASE WHEN ((lo AT TIME ZONE place) - INTERVAL 1 HOUR) AT TIME ZONE place = lo THEN epoch_us(lo AT TIME ZONE place) - 3600000000 ELSE epoch_us(lo AT TIME ZONE place) END) END
  ELSE epoch_us(lo) - CAST(off AS BIGINT) * 60000000 END AS us FROM k)
SELECT t AS record_table, row_id, CAST(pos AS BIGINT) AS pos, us AS epoch_us FROM r WHERE us IS NOT NULL
""",
    "p6_found": f"""
WITH {_UNIT}, {_AZURE}, {_PROMPT}, b AS (SELECT 'azure_retail_prices' AS tb, * FROM a UNION ALL SELECT 'openrouter_models', * FROM m),
 x AS (SELECT *, regexp_extract(unit, '^([\\d.,]*)(?:\\^(\\d+))?\\s*([a-z]*)\\.?\\s*([a-z]*)$', ['n', 'p', 'a', 'b']) AS g, regexp_matches(unit, '^([\\d.,]*)(?:\\^(\\d+))?\\s*([a-z]*)\\.?\\s*([a-z]*)$') AS ok FROM b),
 y AS (SELECT tb, row_id, amount, cents, (CASE WHEN g.p <> '' THEN CAST(pow(CAST(g.n AS DOUBLE), CAST(g.p AS DOUBLE)) AS DECIMAL(18, 4)) WHEN g.n = '' THEN 1 ELSE TRY_CAST(replace(g.n, ',', '') AS DECIMAL(18, 4)) END) * v.factor * w.factor AS cnt
  FROM x JOIN u v ON v.word = g.a JOIN u w ON w.word = g.b WHERE ok AND NOT (v.thing = 't' AND w.thing = 't'))
SELECT tb AS record_table, row_id, {_MICRO} AS micro_usd_per_mtok FROM y
""",
    "diff_models": _MODELS,
    "diff_prices": _PRICES + """
, c AS (SELECT * FROM j WHERE ok IS NOT NULL AND nk IS NOT NULL AND ov IS DISTINCT FROM nv),
g AS (SELECT model_ref, direction, count(*) AS n, count(DISTINCT k) AS regions, arg_min(struct_pack(o := ov, n := nv), row(CASE WHEN tier = 'standard' THEN 0 ELSE 1 END, tier, k)) AS r FROM c GROUP BY model_ref, direction)
SELECT model_ref, direction, n, regions, round(r.o, 2) AS old, round(r.n, 2) AS "new", CASE WHEN r.o = 0 THEN 0.0 ELSE round((r.n - r.o) / r.o * 100, 4) END AS pct FROM g
""",
    "diff_row_counts": _PRICES + """
, g AS (SELECT model_ref, count(*) FILTER (WHERE ok IS NULL) AS added, count(*) FILTER (WHERE nk IS NULL) AS removed FROM j GROUP BY model_ref)
SELECT *, CASE WHEN removed = 0 THEN 'added' WHEN added = 0 THEN 'removed' ELSE 'modified' END AS kind FROM g WHERE added + removed > 0
""",
    "diff_status": """
WITH p AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'O' THEN 'investigating' ELSE 'monitoring' END AS status, o_orderpriority AS c FROM orders),
o AS (SELECT * FROM p WHERE k % 5 <> 0), n AS (SELECT k, id, CASE WHEN k % 4 = 0 THEN 'resolved' ELSE status END AS status, CASE WHEN k % 9 = 0 THEN 'x' ELSE c END AS c FROM p WHERE k % 5 <> 1),
j AS (SELECT n.id, o.id AS oi, o.status AS os, n.status AS ns, o.c AS oc, n.c AS nc FROM n LEFT JOIN o ON n.id = o.id)
SELECT 'outage.started' AS event_type, 'incidents[].id' AS field_path, 'added' AS delta_kind, id AS subject, CAST(NULL AS VARCHAR) AS old, id AS "new" FROM j WHERE oi IS NULL
UNION ALL SELECT 'outage.resolved', 'incidents[].status', 'modified', id, os, ns FROM j WHERE oi IS NOT NULL AND ns = 'resolved' AND os <> 'resolved'
UNION ALL SELECT NULL, 'incidents[].components', 'modified', id, '["' || oc || '"]', '["' || nc || '"]' FROM j WHERE oi IS NOT NULL AND oc <> nc
""",
    "diff_docs": """
WITH p AS (SELECT doc_id AS k, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) END AS m, CASE WHEN doc_id % 2 = 0 THEN 'models[' ELSE 'sections[' END || CAST(doc_id AS VARCHAR) || ']' AS path, sha256(coalesce(text, '')) AS v FROM documents),
o AS (SELECT * FROM p WHERE k % 10 <> 0), n AS (SELECT k, m, path, CASE WHEN k % 7 = 0 THEN 'changed' ELSE v END AS v FROM p WHERE k % 10 <> 1),
j AS (SELECT coalesce(o.path, n.path) AS path, coalesce(o.m, n.m) AS m, o.v AS ov, n.v AS nv, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'modified' END AS kind FROM o FULL OUTER JOIN n ON o.k = n.k WHERE o.v IS DISTINCT FROM n.v)
SELECT CASE WHEN m IS NOT NULL AND kind = 'added' THEN 'model.released' WHEN m IS NOT NULL AND kind = 'removed' THEN 'model.deprecated' END AS event_type, CASE WHEN m IS NOT NULL AND kind <> 'modified' THEN 'models[].id' ELSE path END AS field_path, kind AS delta_kind, coalesce(m, path) AS subject,
 CASE WHEN m IS NOT NULL AND kind = 'added' THEN NULL WHEN m IS NOT NULL AND kind = 'removed' THEN m ELSE ov END AS old, CASE WHEN m IS NOT NULL AND kind = 'removed' THEN NULL WHEN m IS NOT NULL AND kind = 'added' THEN m ELSE nv END AS "new" FROM j
""",
    "set_changes": """
WITH o AS (SELECT DISTINCT page_url FROM documents WHERE page_url IS NOT NULL AND doc_id % 3 <> 0), n AS (SELECT DISTINCT page_url FROM documents WHERE page_url IS NOT NULL AND doc_id % 3 <> 1)
SELECT page_url, 'new' AS change FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT page_url, 'removed' FROM (SELECT * FROM o EXCEPT SELECT * FROM n)
""",
    "stance_changes": """
SELECT source_id, 'auth' AS field, auth AS old, 'none' AS "new" FROM sources WHERE source_id LIKE '%-status' AND auth <> 'none'
UNION ALL SELECT source_id, 'method', method, 'GET' FROM sources WHERE method IS NULL
""",
    "mint_event_ids": """
WITH k AS (SELECT row_id, observed_at, '{"canonical_model_id":' || coalesce('"' || model_id || '"', 'null') || ',"event_type":"' || event_type || '","new_value":' || coalesce('"' || model_id || '"', 'null') || ',"normalized_field_path":"models[].id","old_value":null,"provider":"' || provider || '"}' AS key FROM change_events)
SELECT row_id, key, 'evt_' || strftime(observed_at AT TIME ZONE 'UTC', '%Y%m%d') || '_' || substr(sha256(key), 1, 8) AS minted FROM k
""",
    "minted_and_excepted": """
WITH x AS (SELECT *, CASE WHEN event_type = 'correction.issued' THEN 'unclassified' WHEN provider IS NULL THEN 'provider-unmapped' WHEN model_id IS NULL AND NOT starts_with(event_type, 'outage.') THEN 'alias-unmapped' END AS reason FROM change_events)
SELECT reason, CASE WHEN event_type <> 'correction.issued' THEN event_type END AS event_type, count(*) AS n FROM x WHERE reason IS NOT NULL GROUP BY 1, 2 UNION ALL
SELECT 'minted', event_type, count(*) FROM (SELECT DISTINCT strftime(observed_at AT TIME ZONE 'UTC', '%Y%m%d'), provider, model_id, event_type FROM x WHERE reason IS NULL) GROUP BY event_type
""",
    "evidence_union": """
WITH x AS (SELECT id, row_id, unnest(evidence) AS e, generate_subscripts(evidence, 1) AS pos FROM change_events)
SELECT id, e.source_id AS source_id, e.sha256_full AS sha256_full, arg_min(row_id, row(row_id, pos)) AS row_id, arg_min(e.url, row(row_id, pos)) AS url FROM x GROUP BY ALL
""",
    "dup_within_72h": """
SELECT event_id, user_id, event_type FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS b FROM events) WHERE ts - b < INTERVAL 72 HOURS
""",
    "candidates_72h": """
SELECT e.event_id, e.user_id, arg_max(c.event_id, row(c.ts, c.event_id)) AS candidate FROM events e LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') c
 ON e.user_id = c.user_id AND c.ts <= e.ts AND e.ts - c.ts < INTERVAL 72 HOURS AND e.event_id <> c.event_id GROUP BY e.event_id, e.user_id
""",
    "reversal_pairs": """
WITH k AS (SELECT provider, model_id, event_type, observed_at, '{"canonical_model_id":"' || model_id || '","event_type":"' || event_type || '","new_value":' || CASE event_type WHEN 'model.released' THEN '"' || model_id || '"' ELSE 'null' END || ',"normalized_field_path":"models[].id","old_value":' || CASE event_type WHEN 'model.deprecated' THEN '"' || model_id || '"' ELSE 'null' END || ',"provider":"' || provider || '"}' AS key
 FROM change_events WHERE event_type IN ('model.released', 'model.deprecated') AND model_id IS NOT NULL),
 i AS (SELECT 'evt_' || strftime(observed_at AT TIME ZONE 'UTC', '%Y%m%d') || '_' || substr(sha256(key), 1, 8) AS id, provider, model_id, event_type, min(observed_at) AS at FROM k GROUP BY ALL)
SELECT a.id, arg_max(b.id, row(b.at, b.id)) AS undone FROM i a JOIN i b ON a.provider = b.provider AND a.model_id = b.model_id AND a.event_type <> b.event_type AND a.at >= b.at AND a.at < b.at + INTERVAL 1440 HOUR GROUP BY a.id
""",
    "independent_sources": """
WITH s AS (SELECT source_id, source_class, CASE WHEN lineage = 'third-party-aggregator' OR source_class = 'provider-docs' THEN 'provider-docs' WHEN lineage = 'own-probe' OR source_class = 'own-probe' THEN 'own-probe' ELSE source_class END AS l FROM sources),
 e AS (SELECT row_id, unnest(evidence).source_id AS source_id FROM change_events),
 x AS (SELECT row_id, source_class, l FROM e JOIN s USING (source_id))
SELECT row_id, EXISTS (SELECT 1 FROM x a, x b WHERE a.row_id = r.row_id AND b.row_id = r.row_id AND a.source_class <> b.source_class AND a.l <> b.l) AS independent FROM change_events r
""",
    "robots_stance": r"""
WITH m AS (SELECT row_id, coalesce(http_status, 0) AS s, '/' || regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1) AS p FROM manifests)
SELECT row_id, CASE WHEN s BETWEEN 200 AND 299 THEN NOT regexp_matches(p, '^/.*-list$') AND NOT regexp_matches(p, '^/mo.*-docs') ELSE s BETWEEN 400 AND 499 AND s <> 429 END AS reader,
 CASE WHEN s BETWEEN 200 AND 299 THEN regexp_matches(p, '^/stat.*s$') ELSE s BETWEEN 400 AND 499 AND s <> 429 END AS watcher FROM m
""",
    "alias_index": """
WITH e AS (SELECT canonical_id, unnest(map_entries(aliases)) AS e FROM model_aliases), a AS (SELECT canonical_id, e.key AS namespace, unnest(e.value) AS alias FROM e)
SELECT namespace, alias, max(canonical_id) AS canonical_id FROM a GROUP BY namespace, alias
""",
    "provider_of_models": "SELECT row_id, (SELECT min(provider) FROM model_aliases a WHERE contains(m.id, '/') AND a.provider = split_part(m.id, '/', 1)) AS provider FROM openrouter_models m",
    "corrected_by": "SELECT correction_of AS id, string_agg(DISTINCT id, ',' ORDER BY id) AS correctors FROM change_events WHERE correction_of IS NOT NULL GROUP BY correction_of",
    "dangling_refs": """
WITH x AS (SELECT id, unnest(evidence) AS e FROM change_events),
 r AS (SELECT 'E-REF' AS code, 'corrects: ' || correction_of AS message FROM change_events c WHERE correction_of IS NOT NULL AND NOT EXISTS (SELECT 1 FROM change_events t WHERE t.id = c.correction_of)
  UNION ALL SELECT 'E-REF', 'source: ' || e.source_id FROM x WHERE e.source_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sources t WHERE t.source_id = x.e.source_id)
  UNION ALL SELECT 'E-REF', 'manifest: ' || e.manifest_path FROM x WHERE e.manifest_path IS NOT NULL AND NOT EXISTS (SELECT 1 FROM manifests t WHERE t.path = x.e.manifest_path)
  UNION ALL SELECT 'E-ID', 'malformed, or not of the day observed' FROM change_events WHERE NOT coalesce(regexp_matches(id, '^evt_[0-9]{8}_[0-9a-f]{8}$') AND substr(id, 5, 8) = strftime(observed_at AT TIME ZONE 'UTC', '%Y%m%d'), false)
  UNION ALL SELECT 'E-DUP', 'id occurs more than once' FROM (SELECT id FROM change_events GROUP BY id HAVING count(*) > 1)
  UNION ALL SELECT 'E-DUP', 'the same change less than 72 hours before' FROM (SELECT o - lag(o) OVER (PARTITION BY right(id, 8) ORDER BY o, id) AS g FROM (SELECT id, min(observed_at) AS o FROM change_events GROUP BY id)) WHERE g < INTERVAL 72 HOURS)
SELECT code, message, count(*) AS n FROM r GROUP BY code, message
""",
    "seq_contiguity": """
SELECT 'E-SEQ' AS code, CAST(l_orderkey AS VARCHAR) AS subject FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n FROM lineitem WHERE l_linenumber <> 2 OR l_orderkey % 3 = 0) GROUP BY l_orderkey HAVING bool_or(l_linenumber <> n)
""",
    "next_seq": """
WITH t AS (SELECT l_orderkey, max(l_linenumber) AS m FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_orderkey)
SELECT n.l_orderkey, l_partkey, l_suppkey, CAST(coalesce(m, 0) + row_number() OVER (PARTITION BY n.l_orderkey ORDER BY l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS seq FROM lineitem n LEFT JOIN t ON n.l_orderkey = t.l_orderkey WHERE l_linenumber > 3
""",
    "fold_status": f"{_CHAIN}, {_FOLD} SELECT * FROM f",
    "running_status": f"{_CHAIN} SELECT event_id, seq, coalesce(last_value(dec IGNORE NULLS) OVER (PARTITION BY event_id ORDER BY ts, rank, seq ROWS UNBOUNDED PRECEDING), 'unconfirmed') AS status FROM c",
    "status_as_of": f"""{_CHAIN}, a AS (SELECT event_id AS i, user_id, ts AS at FROM events WHERE event_type = 'view'),
 b AS (SELECT a.i AS event_id, c.ts, c.rank, c.seq, c.kind, c.dec FROM a LEFT JOIN c ON a.user_id = c.event_id AND c.ts <= a.at),
 {_FOLD.replace("FROM c GROUP", "FROM b GROUP")} SELECT event_id AS i, status, discrepancy_open FROM f""",
    "derived_state": f"""{_CHAIN}, {_FOLD} SELECT f.event_id AS id, status, discrepancy_open, (SELECT count(*) FROM c WHERE c.event_id = f.event_id AND kind = 'click') AS published, (SELECT count(*) FROM c WHERE c.event_id = f.event_id AND rank = 1) AS n_verdicts, (SELECT count(*) FROM c WHERE c.event_id = f.event_id AND rank = 0) AS n_annotations FROM f""",
    "event_totals": "SELECT event_type, count(*) AS n, CAST(sum(len(evidence)) AS BIGINT) AS cited, count(*) FILTER (WHERE correction_of IS NOT NULL) AS corrections, count(DISTINCT id) AS ids FROM change_events GROUP BY event_type",
    "latest_snapshot": "SELECT row_id, feed_id, id FROM statuspage_incidents s WHERE run_ts = (SELECT max(run_ts) FROM statuspage_incidents t WHERE t.feed_id = s.feed_id)",
    "absent_events": """
WITH n AS (SELECT id, arg_min(event_type, row_id) AS event_type FROM change_events WHERE row_id % 2 = 0 GROUP BY id)
SELECT event_type, count(*) AS n FROM n WHERE NOT EXISTS (SELECT 1 FROM change_events c WHERE c.row_id % 2 = 1 AND c.id = n.id) GROUP BY event_type
""",
    "cited_manifests": r"""
WITH x AS (SELECT row_id, unnest(evidence) AS e, generate_subscripts(evidence, 1) - 1 AS pos FROM change_events)
SELECT row_id, CAST(pos AS BIGINT) AS pos FROM x WHERE EXISTS (SELECT 1 FROM manifests m WHERE m.path = x.e.manifest_path) AND NOT regexp_matches(e.manifest_path, '^[/\\]|^[A-Za-z]:|(^|[/\\])\.\.([/\\]|$)')
""",
    "sources_of_urls": "WITH s AS (SELECT lower(url) AS u, min(source_id) AS source_id FROM sources GROUP BY lower(url)) SELECT row_id, s.source_id FROM manifests m LEFT JOIN s ON s.u = m.url",
    "refused_urls": """
WITH h AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS h, bool_or(excluded) AS x FROM sources WHERE lineage <> 'own' GROUP BY 1)
SELECT CASE WHEN h.h IS NULL THEN 'unregistered host' WHEN x THEN 'excluded host' END AS reason, count(*) AS n FROM manifests m LEFT JOIN h ON h.h = regexp_extract(m.url, '^https?://([^/]+)', 1) GROUP BY 1
""",
    "source_kinds": """
SELECT source_id, CASE WHEN source_class = 'statuspage' THEN 'statuspage' WHEN source_class IN ('provider-docs', 'policy-page') THEN 'docs-html'
 WHEN source_class IN ('official-api', 'third-party-aggregator') THEN CASE WHEN regexp_matches(lower(source_id), 'price|pricing|retail') THEN 'pricing-api' ELSE 'models-api' END END AS kind FROM sources
""",
    "canonical_urls": "SELECT doc_id, page_url || '?a=1' AS url, true AS secret, 'token' AS names FROM documents WHERE page_url IS NOT NULL",
    "meter_tokens": r"""
WITH w AS (SELECT row_id, list_filter(regexp_split_to_array(lower(regexp_replace(meter_name, '[ _]', ' ', 'g')), '[ \t\n\x{0B}\f\r\-]+'), lambda x: x <> '') AS w FROM azure_retail_prices WHERE meter_name IS NOT NULL),
 d AS (SELECT row_id, w, list_distinct(list_filter(list_transform(w, lambda x: CASE WHEN x IN ('inp', 'in', 'inpt', 'input') THEN 'input' WHEN x IN ('outp', 'out', 'outpt', 'output') THEN 'output' END), lambda x: x IS NOT NULL)) AS dir,
  list_distinct(list_filter(list_transform(w, lambda x: CASE WHEN x = 'batch' THEN 'batch' WHEN x IN ('cached', 'cchd', 'cachd', 'cd') THEN 'cached_read' WHEN x = 'pp' THEN 'priority' END), lambda x: x IS NOT NULL)) AS tier,
  list_sort(list_distinct(list_filter(list_transform(w, lambda x: CASE WHEN x IN ('gl', 'glbl', 'global') THEN 'global' WHEN x IN ('dz', 'dzn', 'datazone') THEN 'datazone' WHEN x IN ('regnl', 'rgnl', 'regional') THEN 'regional' END), lambda x: x IS NOT NULL))) AS sc,
  list_filter(w, lambda x: x NOT IN ('inp', 'in', 'inpt', 'input', 'outp', 'out', 'outpt', 'output', 'batch', 'cached', 'cchd', 'cachd', 'cd', 'pp', 'gl', 'glbl', 'global', 'dz', 'dzn', 'datazone', 'regnl', 'rgnl', 'regional', '1k', '1m', 'tokens', 'token')) AS base FROM w)
SELECT row_id, dir[1] AS direction, coalesce(tier[1], 'standard') AS tier, sc[1] AS scope, array_to_string(base, '-') || coalesce('-' || sc[1], '') AS model_ref FROM d
WHERE len(dir) = 1 AND len(tier) <= 1 AND len(base) > 0 AND (list_contains(w, 'tokens') OR list_contains(w, 'token'))
""",
    "unpivot_costs": """
SELECT 'm' || p_partkey AS model_ref, 'input' AS direction, 'standard' AS tier, CAST(p_size AS DOUBLE) * 1000000 AS value FROM part UNION ALL SELECT 'm' || p_partkey, 'output', 'standard', CAST(p_size AS DOUBLE) * 2000000 FROM part
""",
    "model_payloads": "SELECT row_id, id, context_length AS context_window, array_to_string(list_sort(list_distinct(list_concat(coalesce(input_modalities, []), coalesce(output_modalities, [])))), ',') AS modalities FROM openrouter_models WHERE id IS NOT NULL",
    "incident_payloads": "SELECT row_id, id, status, array_to_string(list_sort(list_distinct(list_filter(list_transform(components, lambda c: c.name), lambda x: x IS NOT NULL))), '|') AS components FROM statuspage_incidents WHERE id IS NOT NULL AND status IS NOT NULL AND updated_at IS NOT NULL",
    "keyword_lifecycle": """
SELECT doc_id, CASE WHEN contains(t, 'resolved') THEN 'resolved' WHEN contains(t, 'mitigated') THEN 'resolved' WHEN contains(t, 'restored') THEN 'resolved' WHEN contains(t, 'investigating') THEN 'investigating' WHEN contains(t, 'monitoring') THEN 'monitoring'
 WHEN contains(t, 'degradation') THEN 'identified' WHEN contains(t, 'degraded') THEN 'identified' ELSE 'active' END AS state FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents)
""",
    "text_hashes": f"SELECT doc_id, substr(sha256(trim(regexp_replace(nfc_normalize(text), '{_WS}+', ' ', 'g'), ' ')), 1, 16) AS h FROM documents",
    "slugs": """
WITH s AS (SELECT row_id, regexp_replace(regexp_replace(lower(meter_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM azure_retail_prices)
SELECT row_id, coalesce(nullif(regexp_replace(substr(s, 1, 60), '-+$', ''), ''), 'untitled') AS slug FROM s
""",
    "email_scan": r"""
WITH d AS (SELECT doc_id, concat_ws(' ', text, source || '@' || lang || '.example') AS t FROM documents), l AS (SELECT doc_id, unnest(string_split(t, E'\n')) AS text, generate_subscripts(string_split(t, E'\n'), 1) AS line FROM d),
 m AS (SELECT doc_id, line, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}')) AS m FROM l)
SELECT doc_id, line, substr(m, 1, 1) || '***@' || split_part(m, '@', 2) AS masked FROM m
""",
    "write_scopes": """
SELECT row_id FROM manifests WHERE NOT ((regexp_matches(source_id, '-status$') AND starts_with(path, 'manifests/evidence/')) OR (regexp_matches(source_id, '^arbrix-') AND starts_with(path, 'manifests/')) OR (regexp_matches(source_id, '-price-list$') AND starts_with(path, 'manifests/evidence/corvale')))
""",
    "rewritten_paths": "SELECT CASE WHEN row_id % 3 = 1 THEN 'M' ELSE 'R' END AS status, path FROM manifests WHERE row_id % 3 > 0 AND starts_with(path, 'manifests/')",
    "blocked_collection": "SELECT lineage AS host, bool_or(NOT excluded AND source_id LIKE '%-1') AS blocking FROM sources GROUP BY lineage",
    "pins_missed": "SELECT source_id, coalesce(zone, 'UTC') AS want, CASE WHEN zone <> 'Asia/Tokyo' THEN zone END AS have FROM sources WHERE zone IS NULL OR zone = 'Asia/Tokyo'",
    "quote_states": f"SELECT CASE WHEN contains(trim(regexp_replace(nfc_normalize(text), '{_WS}+', ' ', 'g')), 'No data was lost') THEN 'quoted' ELSE 'lapsed' END AS state, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "section_names": r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), E'\n')) AS t, generate_subscripts(string_split(coalesce(text, ''), E'\n'), 1) - 1 AS pos FROM documents),
 g AS (SELECT *, max(CASE WHEN starts_with(t, '# ') THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM l),
 h AS (SELECT doc_id, n, coalesce(nullif(regexp_replace(substr(regexp_replace(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60), '-+$', ''), ''), 'untitled') AS name FROM g WHERE pos = n),
 b AS (SELECT doc_id, n, sum(length(t)) + count(*) - 1 AS chars FROM g WHERE n IS NOT NULL AND pos > n GROUP BY doc_id, n),
 i AS (SELECT h.*, coalesce(b.chars, 0) AS chars, row_number() OVER (PARTITION BY h.doc_id, h.name ORDER BY h.n) AS k FROM h LEFT JOIN b ON h.doc_id = b.doc_id AND h.n = b.n)
SELECT doc_id, n, CASE WHEN k > 1 THEN name || '-' || k ELSE name END AS name, CAST(chars AS BIGINT) AS chars FROM i
""",
}

ORACLE["p4_report"] = f"SELECT field, period, kind, count(*) AS n FROM ({ORACLE['p4_found']}) GROUP BY ALL"
_NAMES = ORACLE["meter_tokens"].replace("regexp_replace(meter_name, '[ _]', ' ', 'g')", "meter_name")
ORACLE["retail_rows"] = f"""
WITH t AS ({_NAMES}), p AS (SELECT source_id, direction, tier, round(retail_price * CASE unit_of_measure WHEN '1K' THEN 1000 ELSE 1 END, 10) AS v FROM azure_retail_prices JOIN t USING (row_id)
 WHERE price_type = 'Consumption' AND currency_code = 'USD' AND unit_of_measure IN ('1K', '1M') AND retail_price IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY source_id, model_ref, direction, tier, coalesce(nullif(arm_region_name, ''), 'global') ORDER BY coalesce(CAST(is_primary_meter_region AS INT), 0) DESC, coalesce(effective_start_date, '') DESC, coalesce(meter_id, ''), v DESC) = 1)
SELECT source_id, direction, tier, count(*) AS n, round(sum(v), 3) AS total FROM p GROUP BY ALL
"""
_REFS = ORACLE["p4_found"].split(" k AS (SELECT refs.*")[0].rstrip().rstrip(",")
ORACLE["p4_keys"] = f"""{_REFS}
SELECT CASE refs.field WHEN 'source_id' THEN 'sources' WHEN 'manifest_path' THEN 'manifests' ELSE 'change_events' END AS target_table, refs.key, count(*) AS refs, epoch_us(min(t.a)) AS first_us, epoch_us(max(t.d)) AS gone_us
FROM refs LEFT JOIN t ON refs.field = t.field AND refs.key = t.key WHERE refs.key IS NOT NULL AND (t.key IS NULL OR t.d IS NOT NULL) GROUP BY 1, 2"""
ORACLE["sentences"] = r"""
WITH s AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents),
 n AS (SELECT doc_id, len(list_filter(s, lambda x: contains(lower(x), 'requests') AND contains(lower(x), 'per minute'))) AS n FROM s)
SELECT doc_id, n FROM n WHERE n > 0
"""
