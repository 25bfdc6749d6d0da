"""SQL twins of the registered queries, where SQL can express them."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

ORACLE_SQL["op6_mixing"] = rf"""
WITH sized AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight,
         3 * source_size AS most
  FROM totals),
filled AS (
  SELECT *, sum(source_size) OVER () AS everything,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
         coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
  FROM weighed
  WINDOW o AS (ORDER BY most::DOUBLE / weight, source IS NULL, encode(source))),
rates AS (
  SELECT *, (everything - used)::DOUBLE / weights::DOUBLE AS rate FROM filled),
targets AS (
  SELECT source, source_size, coalesce(least(most::DOUBLE, weight * (
           SELECT max(rate) FROM rates)), 0.0) AS target
  FROM rates),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, s.source,
         floor(t.target + 0.5)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
       (size * epochs + greatest(0, least(size, budget - epochs * source_size - place)))::BIGINT AS taken,
       source
FROM epochs
"""

ORACLE_SQL["op8_warc"] = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, unhex(sha1(coalesce(html, ''))) AS sha
  FROM pages),
bits AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h FROM payloads),
digests AS (
  SELECT page_id, payload_bytes, h,
         list_aggregate(list_transform(range(0, 32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, 1 + (i // 8) * 10, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT,
           1)), 'string_agg', '') AS payload_digest
  FROM bits),
firsts AS (SELECT h, max(page_id) AS first_id FROM digests GROUP BY h)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN NOT first THEN first_id END AS refers_to
FROM (SELECT *, d.page_id IS NOT DISTINCT FROM first_id AND (
        d.page_id IS NULL OR row_number() OVER (PARTITION BY d.page_id, h) = 1) AS first
      FROM digests d JOIN firsts USING (h)) d
"""

ORACLE_SQL["op9_exact_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.w, d.w)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND q.vec_id % 50 = 0 AND len(q.w) = len(d.w))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM scores) WHERE rank <= 5
"""

ORACLE_SQL["op4_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS n_both
  FROM shingles a JOIN shingles b USING (x) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * n_both >= 75 * (na + nb - n_both)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT doc_id, doc_id FROM documents),
reach AS (
  SELECT a AS doc_id, b AS other FROM edges
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a),
roots AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN roots r USING (doc_id)
"""

ORACLE_SQL["op2_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM split),
numbered AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM lines),
pairs AS (
  SELECT b.doc_id, b.i, b.w, a.doc_id AS other, b.i - a.i AS diagonal
  FROM numbered a JOIN numbered b USING (line)
  WHERE a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.i < b.i)),
runs AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, other, diagonal ORDER BY i) AS run FROM pairs),
long_runs AS (
  SELECT doc_id, other, diagonal, run FROM runs GROUP BY ALL HAVING sum(w) >= 50),
gone AS (SELECT DISTINCT doc_id, i FROM runs SEMI JOIN long_runs USING (doc_id, other, diagonal, run)),
kept AS (
  SELECT doc_id, count(g.i) AS n_removed,
         string_agg(CASE WHEN g.i IS NULL THEN line END, chr(10) ORDER BY l.i) AS text
  FROM lines l LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

ORACLE_SQL["op12_lexical_search"] = r"""
WITH found AS (
  SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT doc_id, row_no, w, len(w)::BIGINT AS n FROM found WHERE len(w) > 0),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM docs),
postings AS (
  SELECT row_no, term, count(*)::BIGINT AS tf FROM (SELECT row_no, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * c.docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM postings, corpus c GROUP BY term, c.docs),
items AS (
  SELECT item_id, item_no, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, row_number() OVER () AS item_no, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT i.item_id, i.item_no, d.doc_id, d.row_no, sum(i.times * w.weight * (
    (1000000000 * p.tf) // (1000 * p.tf + 12 * (100 - 25 + (25 * d.n * c.docs) // c.total))))::BIGINT AS score
  FROM items i JOIN weights w USING (term) JOIN postings p USING (term) JOIN docs d USING (row_no), corpus c
  GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST, row_no)::INT AS rank
  FROM scores WHERE score > 0) WHERE rank <= 20
"""
