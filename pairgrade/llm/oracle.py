"""SQL (DuckDB) of the operators that SQL can express on whole tables."""

#: Windows of 13 words; a word goes if a window over it starts in a document
#: with a smaller id as well.
SUBSTRING = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS a FROM d WHERE len(w) >= 13),
v AS (SELECT doc_id, a, array_to_string(w[a:a + 12], ' ') AS t FROM p),
m AS (SELECT t, min(doc_id) AS least FROM v GROUP BY t),
late AS (SELECT v.doc_id, v.a FROM v JOIN m ON v.t = m.t WHERE v.doc_id > m.least),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, a + 13)) AS i FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: Windows of 10 words of benchmark items (a shorter item is one), looked up at
#: every place of every document.
DECONTAMINATE = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[a:a + n - 1], ' ') AS t
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM sized)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM sized),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, sizes WHERE len(w) >= n),
hits AS (
  SELECT doc_id, a, p.n, item FROM (SELECT doc_id, a, n, array_to_string(w[a:a + n - 1], ' ') AS t FROM places) p
  JOIN windows ON windows.n = p.n AND windows.t = p.t),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS i FROM hits)
        GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id
"""

#: Copies of each text; null is an empty one.
EXACT = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

#: Inner products of every anchor with every row, coordinate by coordinate.
NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) for c in embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
c AS (SELECT vec_id, label, unnest(x) AS x, unnest(range(len(x))) AS i FROM v),
s AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM c a JOIN c b ON a.i = b.i WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
  GROUP BY a.vec_id, b.vec_id, a.label = b.label),
p AS (
  SELECT anchor, other AS positive, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.positive AS positive_id,
       CAST(row_number() OVER w AS INTEGER) AS rank, s.other AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other)
QUALIFY row_number() OVER w <= 10
"""
