"""SQL for the queries that SQL can express, to be run by DuckDB on the same tables."""

from __future__ import annotations

URL_RULES = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
    ('org', '/fr/', 'allow')
), found AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN found USING (page_id)
"""

TOP_5 = """
WITH parts AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), bad AS (
  SELECT DISTINCT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x)
), v AS (
  SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM parts WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
), parts AS (
  SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM rows
), bad AS (
  SELECT DISTINCT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x)
), v AS (
  SELECT vec_id, label, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM parts WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.i = c.i AND a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0 GROUP BY ALL
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
)
SELECT * FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_url_rules": URL_RULES, "op9_threshold_top5": TOP_5, "op11_hard_negatives": HARD_NEGATIVES}
