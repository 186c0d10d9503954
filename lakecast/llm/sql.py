"""The operators' results in DuckDB's SQL, for those that SQL can express."""

from __future__ import annotations

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"


def _draw(*parts: str) -> str:
    texts = " || ':' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"CAST('0x' || substr(md5('7:' || {texts}), 1, 15) AS BIGINT)"


def _run(k: int, last: bool) -> str:
    """The k-th run of seeded sampling: from rows after the one before, that fit what is left."""
    inner = "upto - words / 2.0" if last else "upto"
    return f"""
    left{k} AS (
      SELECT d.source, d.draw, d.size, r.rest FROM docs d
      JOIN rest{k} r ON d.source IS NOT DISTINCT FROM r.source
      WHERE r.rest > 0 AND d.draw > r.after AND d.size <= r.fits),
    sums{k} AS (
      SELECT *, sum(words) OVER (PARTITION BY source ORDER BY draw) AS upto
      FROM (SELECT source, draw, rest, sum(size) AS words FROM left{k} GROUP BY ALL)),
    ends{k} AS (
      SELECT source, max(draw) FILTER ({inner} <= rest) AS last_in, max(upto) FILTER ({inner} <= rest) AS taken,
             max(upto) AS everything
      FROM sums{k} GROUP BY source),
    rest{k + 1} AS (
      SELECT r.source,
             CASE WHEN r.rest <= 0 THEN r.rest ELSE r.rest - coalesce(e.taken, 0) END AS rest,
             CASE WHEN r.rest <= 0 THEN r.after WHEN e.everything <= r.rest OR e.source_n IS NULL THEN CAST(1152921504606846976 AS BIGINT)
                  ELSE greatest(r.after, coalesce(e.last_in, r.after)) END AS after,
             CASE WHEN r.rest <= 0 THEN r.fits ELSE r.rest - coalesce(e.taken, 0) END AS fits
      FROM rest{k} r LEFT JOIN (SELECT *, 1 AS source_n FROM ends{k}) e ON e.source IS NOT DISTINCT FROM r.source)"""


OP4 = rf"""
WITH docs AS (
  SELECT doc_id, source, {_WORDS} AS size, {_draw("doc_id", "text")} AS draw FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size, 2.0::DOUBLE * sum(size) AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM docs GROUP BY source),
-- The level at which exactly the sources up to a place (by cap per weight) are clamped.
levels AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS clamped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight,
         sum(source_size) OVER () AS total
  FROM sources WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT (1.5::DOUBLE * total - clamped) / open_weight AS level FROM levels
  WHERE (1.5::DOUBLE * total - clamped) / open_weight <= cap / weight ORDER BY cap / weight LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN weight * level > cap THEN cap ELSE weight * level END AS target
  FROM sources, level),
rest0 AS (
  SELECT source, target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest,
         CAST(-1 AS BIGINT) AS after, CAST('inf' AS DOUBLE) AS fits
  FROM targets),
{_run(0, False)}, {_run(1, False)}, {_run(2, True)},
runs AS (
  SELECT a.source, a.after AS a0, b.after AS a1, c.after AS a2, d.after AS a3, a.fits AS f0, b.fits AS f1, c.fits AS f2
  FROM rest0 a JOIN rest1 b ON a.source IS NOT DISTINCT FROM b.source
  JOIN rest2 c ON a.source IS NOT DISTINCT FROM c.source JOIN rest3 d ON a.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END
         + CASE WHEN (draw > a0 AND draw <= a1 AND size <= f0) OR (draw > a1 AND draw <= a2 AND size <= f1)
                  OR (draw > a2 AND draw <= a3 AND size <= f2) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source JOIN runs r ON d.source IS NOT DISTINCT FROM r.source
"""

OP2 = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.parts AS DOUBLE[]), CAST(c.parts AS DOUBLE[])) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id AND len(q.parts) = len(c.parts) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

OP5 = """
WITH pages_ AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM pages_)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS BIGINT) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

# CRC-32 by its rule: eight steps a byte, folded over the bytes of the text.
_CRC_TABLE = "list_transform(range(0, 256), lambda n: list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"

OP10 = f"""
WITH crc_table AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
rows_ AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {_draw("doc_id", "source")} AS draw FROM documents),
placed AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY draw, doc_id) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS place
  FROM rows_),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY place, source NULLS LAST, draw, doc_id) - 1 AS nth, count(*) OVER () AS n FROM placed),
cut AS (SELECT *, CAST((8 * nth) // n AS INTEGER) AS shard, hex(encode(text)) AS digits FROM ranked),
bytes_ AS MATERIALIZED (
  SELECT * EXCLUDE (digits), list_transform(CASE WHEN text = '' THEN [] ELSE regexp_extract_all(digits, '..') END, lambda x: CAST('0x' || x AS BIGINT)) AS codes FROM cut)
SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size,
       xor(4294967295, list_reduce(codes, lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT))) AS text_crc32,
       'rows' AS law, shard, CAST(nth - (shard * n + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM bytes_, crc_table
"""

OP11 = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS parts FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(CAST(a.parts AS DOUBLE[]), CAST(c.parts AS DOUBLE[])) AS BIGINT) AS score
  FROM sound a JOIN sound c ON a.vec_id <> c.vec_id AND len(a.parts) = len(c.parts) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""

# Equal sets are one node. Links are counted over shared shingles, and reached nodes are spread until none is new.
OP12 = r"""
WITH words_ AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS shingles FROM words_),
nodes AS MATERIALIZED (
  SELECT shingles, md5(array_to_string(shingles, '\n')) AS digest, min(doc_id) AS node, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
tokens AS MATERIALIZED (SELECT node, n, unnest(shingles) AS token FROM nodes),
links AS MATERIALIZED (
  SELECT a.node AS u, b.node AS v FROM tokens a JOIN tokens b ON a.token = b.token AND a.node < b.node
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  WITH RECURSIVE r(node, seen) AS (
    SELECT node, node FROM nodes
    UNION
    SELECT r.node, l.v FROM r JOIN (SELECT u, v FROM links UNION ALL SELECT v, u FROM links) l ON r.seen = l.u)
  SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(r.component, s.doc_id) AS component_id, s.doc_id = coalesce(r.component, s.doc_id) AS kept
FROM sets s LEFT JOIN nodes d ON len(s.shingles) > 0 AND md5(array_to_string(s.shingles, '\n')) = d.digest LEFT JOIN reach r ON d.node = r.node
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = f"""
WITH postings AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL),
lengths AS MATERIALIZED (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM postings, whole GROUP BY term, docs),
strata AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM lengths, whole),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN strata USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""
