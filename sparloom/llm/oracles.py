"""DuckDB twins of the operators that SQL can say, over whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, {_ALNUM}) AS w FROM documents),
 b AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, {_ALNUM}) AS w FROM benchmark),
 n AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
 t AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM n)),
 s AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
   FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n)),
 h AS (SELECT s.doc_id, s.n, s.i, t.item_id FROM s JOIN t ON s.n = t.n AND s.k = t.k),
 c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
 m AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT doc_id, i, rank() OVER (PARTITION BY k ORDER BY doc_id, i) AS place FROM (
   SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20))),
 g AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM s WHERE place > 1)),
 k AS (SELECT u.doc_id, count(g.p) AS n_removed, string_agg(CASE WHEN g.p IS NULL THEN x END, ' ' ORDER BY u.p) AS kept
   FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) u LEFT JOIN g ON g.doc_id = u.doc_id AND g.p = u.p GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
