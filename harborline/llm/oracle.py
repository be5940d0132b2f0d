"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op7_extendible_index"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE["op12_segment_mining"] = """
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, v.r, v.vec_id, v.label = a.label AS same,
         list_dot_product(a.e, v.e)::BIGINT AS score
  FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.r <> v.r
), positives AS (
  SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives AS p JOIN scored AS s
    ON s.anchor = p.anchor AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""
