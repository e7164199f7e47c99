"""The SQL that the document queries must equal, where SQL can state them."""

from __future__ import annotations

# A-Z to lower case leaves other letters as they are.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS span
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)
), m AS (SELECT doc_id, s, dw.size AS size, item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.span = bw.span),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS pos FROM m) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP3 = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
  sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""

OP9 = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[k] || ' ' || w[k + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS k FROM d WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)
"""

OP11 = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY x) AS first_id FROM t),
marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x) AS c,
    regexp_matches(x, '[#$%&*|]') AS d, coalesce(first_id < w.doc_id, false) AS e
  FROM w LEFT JOIN marks ON w.doc_id = marks.doc_id
), fails AS (
  SELECT part, good, toxic,
    CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
      || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS failed, count(*) AS n
  FROM f GROUP BY ALL
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
  FROM orders, range(1, 6) AS r(step)
), told AS (
  SELECT part, filter_order, step, own, n, good, toxic, contains(failed, own) AS fails, failed = own AS only_own,
    translate(failed, before, '') <> failed AS gone
  FROM fails, steps
), counted AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant, coalesce(sum(n) FILTER (only_own), 0) AS unique_fails,
    coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0) AS toxic_lost
  FROM told GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

# CRC-32 by its table: bits from low to high, polynomial 0xEDB88320.
OP13 = r"""
WITH RECURSIVE bits(b, k, c) AS (
  SELECT b, 0, b FROM range(256) AS r(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
o AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({'r': r, 't': t} ORDER BY i) AS turns FROM o GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, conv_id - conv_id % 5 AS base, CAST(xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda s, x: xor(crc.t[(xor(s, x) & 255) + 1], s >> 8)), 4294967295) % 9 AS INTEGER) AS h
  FROM c, crc
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns FROM h a LEFT JOIN c b ON b.conv_id = a.base
), p AS (
  SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS ends FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), n AS MATERIALIZED (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(strlen(path[d].t), 0) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY path, d
), kids AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
told AS (
  SELECT n.*, coalesce(kids.n, 0) AS n_children, parent.conv_id AS parent_conv_id
  FROM n LEFT JOIN kids ON kids.path = n.path AND kids.d = n.d
    LEFT JOIN n parent ON parent.d = n.d - 1 AND parent.path = n.path[1:n.d - 1]
), up AS (SELECT path[1:u] AS path, u AS d, saved, n_children FROM (SELECT *, unnest(range(d + 1)) AS u FROM told)),
sums AS (SELECT path, d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY path, d)
SELECT conv_id, CAST(told.d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM told JOIN sums ON sums.path = told.path AND sums.d = told.d
"""


def all_statements() -> dict[str, str]:
    return {"op1_decontamination": OP1, "op3_exact_dedup": OP3, "op9_near_dedup": OP9, "op11_filter_audit": OP11, "op13_prefix_trie": OP13}
