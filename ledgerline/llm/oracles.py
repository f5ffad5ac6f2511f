"""Brute force in DuckDB SQL for the operators whose results SQL can express: every
pair, window or shingle is looked at, none of the operators' methods is repeated."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"  # after lowering A-Z
_SPACED = r"'[^\x20\x09-\x0D]+'"


def _low(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


_VECTORS = """
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

SQL: dict[str, str] = {
    "op2_cover_tree_top_k": f"""
WITH v AS ({_VECTORS}),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op12_ranked_search": f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_low("text")}, {_WORD}) AS words FROM documents),
docs AS (SELECT rid, doc_id, words, len(words) AS n FROM texts WHERE len(words) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM docs),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_low("text")}, {_WORD})) AS term FROM benchmark),
counts AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(words) AS term FROM docs) SEMI JOIN wanted USING (term) GROUP BY rid, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, total GROUP BY term, n_docs
),
scores AS (
  SELECT item_id, rid, any_value(doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM counts JOIN docs USING (rid) JOIN weights USING (term) JOIN wanted USING (term), total GROUP BY item_id, rid
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50""",
    "op13_hard_negatives": f"""
WITH v AS (SELECT vec_id, x, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM ({_VECTORS}) WHERE label IS NOT NULL),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
    "op5_substring_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, {_SPACED}), []) AS words FROM documents),
w AS (SELECT rid, doc_id, p, array_to_string(words[p + 1 : p + 50], ' ') AS win FROM d, unnest(range(len(words) - 49)) u(p)),
firsts AS (SELECT win, min(doc_id) AS first FROM w GROUP BY win),
gone AS (SELECT DISTINCT rid, p + i AS word FROM w JOIN firsts USING (win), unnest(range(50)) u(i) WHERE first < doc_id),
kept AS (
  SELECT d.rid, string_agg(words[p + 1], ' ' ORDER BY p) AS text, count(*) AS n
  FROM d, unnest(range(len(words))) u(p) LEFT JOIN gone g ON g.rid = d.rid AND g.word = p WHERE g.rid IS NULL GROUP BY d.rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)""",
    "op7_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all({_low("text")}, {_WORD}), []) AS words FROM documents),
pos AS (SELECT rid, words[p + 1] AS term, p FROM d, unnest(range(len(words))) u(p)),
items AS (SELECT item_id, regexp_extract_all({_low("text")}, {_WORD}) AS words FROM benchmark),
owned AS (SELECT DISTINCT item_id, words[s + 1 : s + 10] AS win FROM items, unnest(range(greatest(1, len(words) - 9))) u(s) WHERE len(words) > 0),
wins AS (SELECT DISTINCT win, array_to_string(win, ' ') AS phrase, len(win) AS n FROM owned),
runs AS (
  SELECT rid, p, n, array_to_string(words[p + 1 : p + n], ' ') AS phrase FROM d, (SELECT DISTINCT n FROM wins) l, unnest(range(len(words) - n + 1)) u(p)
),
exact AS (SELECT rid, p, n, win FROM runs JOIN wins USING (phrase, n)),
hit AS (SELECT rid, count(DISTINCT p + i) AS n_hit FROM exact, unnest(range(n)) u(i) GROUP BY rid),
named AS (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM exact JOIN owned USING (win) WHERE item_id IS NOT NULL),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM named GROUP BY rid),
places AS (SELECT win, unnest(range(n)) AS k, unnest(win) AS term FROM wins),
counts AS (SELECT term, count(*) AS n FROM pos WHERE term IN (SELECT term FROM places) GROUP BY term),
rarest AS (SELECT win, arg_min(term, coalesce(c.n, 0) * 100 + k) AS rare FROM places LEFT JOIN counts c USING (term) GROUP BY win),
occ AS (SELECT win, rid, p AS at FROM rarest JOIN pos ON term = rare),
lists AS (SELECT rid, term, list(p) AS ps FROM pos WHERE term IN (SELECT term FROM places) GROUP BY rid, term),
near AS (
  SELECT win, occ.rid, occ."at" FROM occ JOIN (SELECT DISTINCT win, term FROM places) t USING (win)
  LEFT JOIN lists l ON l.rid = occ.rid AND l.term = t.term
  GROUP BY win, occ.rid, occ."at" HAVING bool_and(coalesce(len(list_filter(ps, lambda x: abs(x - occ."at") <= 14)) > 0, false))
),
close_by AS (SELECT rid, count(DISTINCT item_id) AS n FROM near JOIN owned USING (win) WHERE item_id IS NOT NULL GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(c.n, 0) AS n_near_items
FROM d LEFT JOIN hit USING (rid) LEFT JOIN found USING (rid) LEFT JOIN close_by c USING (rid)""",
    "op10_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_low("text")}, {_SPACED}), []) AS words FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(words[p + 1 : p + 3], ' ') AS shingle FROM d, unnest(range(greatest(1, len(words) - 2))) u(p) WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (SELECT a, b FROM edges UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.other),
least AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(other, d.doc_id), d.doc_id) AS component_id, coalesce(least(other, d.doc_id), d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)""",
}
