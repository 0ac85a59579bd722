"""SQL that gives the rows of the registered queries, where SQL can express them."""

from __future__ import annotations

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

EXACT = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), g AS (
  SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

NEAR = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS} AS words FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(words) >= 4 THEN [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
    ELSE [] END) AS shingles
  FROM w
), s AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS total, count(*) AS n_both
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT a, b FROM common WHERE 100 * n_both >= 80 * (total - n_both)
), edge AS (
  SELECT a, b FROM link UNION SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

SQL = {"op9_exact_dedup": EXACT, "op10_near_dedup": NEAR}
