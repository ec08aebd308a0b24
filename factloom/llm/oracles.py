"""DuckDB SQL for those training-data queries that SQL can express (the others have brute-force tests)."""

from __future__ import annotations

from factloom.llm.queries import NEAR

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op4_warc_transactions": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to, url, true AS has_request, true AS has_metadata
FROM d LEFT JOIN f USING (payload_digest)""",
    "op8_minhash_neardup": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= {NEAR.words} THEN list_transform(range(1, len(w) - {NEAR.words - 2}), lambda i: array_to_string(w[i:i + {NEAR.words - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM j JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= {NEAR.percent} * (na.n + nb.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(v, x) AS (SELECT a, a FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.x = e.a),
c AS (SELECT v, min(x) AS component FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id, coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.v = d.doc_id""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
