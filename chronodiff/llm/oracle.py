"""SQL that gives the same rows as the queries of this subpackage, in DuckDB's dialect."""

from __future__ import annotations

_WINDOWS = """
WITH w AS (SELECT doc_id, i, substr(text, i, 200) AS s FROM (SELECT doc_id, text, unnest(generate_series(1, length(text) - 199)) AS i FROM documents WHERE length(text) >= 200)),
 h AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) <> max(doc_id))
"""

ORACLE: dict[str, str] = {
    "p9_found": f"""{_WINDOWS}, m AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w JOIN h USING (s))
SELECT doc_id, CAST(sum(least(200, coalesce(i - p, 200))) AS BIGINT) AS shared_chars FROM m GROUP BY doc_id""",
    "p9_repeats": f"""{_WINDOWS}, m AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w JOIN h USING (s) WHERE first < doc_id),
 g AS (SELECT doc_id, i, sum(CASE WHEN i - p <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM m)
SELECT doc_id, CAST(min(i) - 1 AS BIGINT) AS "start", CAST(max(i) + 199 AS BIGINT) AS stop FROM g GROUP BY doc_id, g""",
}
