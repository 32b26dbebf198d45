"""SQL of queries whose operators are in other modules."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w FROM documents
), sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id), link AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), edge AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link), r AS (
  SELECT a AS id, a AS root FROM edge UNION SELECT e.b, r.root FROM r JOIN edge e ON e.a = r.id
), c AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id, coalesce(c.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.id = d.doc_id
"""
