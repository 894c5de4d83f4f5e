"""The same answers in plain SQL, for the operators that SQL can express."""

from __future__ import annotations

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.93),
reach AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least AS (SELECT u, least(u, min(v)) AS component_id FROM reach GROUP BY u),
counted AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
       coalesce(component_id, e.vec_id) AS component_id,
       coalesce(e.vec_id = coalesce(component_id, e.vec_id), true) AS kept
FROM embeddings e LEFT JOIN least ON least.u = e.vec_id LEFT JOIN counted ON counted.u = e.vec_id
"""


FIM = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e),
o AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, z - a) AS m, substring(t, z + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o
"""

LINE_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (
  SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT r, doc_id, key FROM k WHERE length(key) >= 40) GROUP BY key HAVING count(*) >= 5),
marked AS (
  SELECT k.r, k.doc_id, pos, line, shared.key IS NOT NULL AND k.doc_id IS DISTINCT FROM last AS gone FROM k LEFT JOIN shared ON k.key = shared.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

# the checksum of every distinct word, byte by byte over a table of 256 entries that its rule gives
RESAMPLING = r"""
WITH crc_step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS step),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT r, unnest(words) AS word FROM d),
bw AS (SELECT unnest(words) AS word FROM b),
vocabulary AS (SELECT word FROM dw UNION SELECT word FROM bw),
bucketed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(hex(encode(word))), 2),
      lambda i: CAST('0x' || substr(hex(encode(word)), i, 2) AS BIGINT))),
    lambda c, x: xor(step[CAST(xor(c % 256, x) + 1 AS BIGINT)], c >> 8)), 4294967295) % 10000 AS bucket
  FROM vocabulary, crc_step),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN bucketed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN bucketed USING (word) GROUP BY bucket),
sizes AS (SELECT (SELECT count(*) FROM dw) AS sa, (SELECT count(*) FROM bw) AS ta),
gains AS (
  SELECT range AS bucket, floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(sa + 10000 AS DOUBLE)
    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(ta + 10000 AS DOUBLE)))) AS gain
  FROM range(10000) LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range, sizes),
weights AS (
  SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM dw JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights ON weights.r = d.r),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * able // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn ON drawn.r = scored.r
"""


WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS kept FROM p),
r AS (SELECT *, kept IS NOT NULL AND page_id IS DISTINCT FROM kept AS again FROM k)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN kept END AS refers_to
FROM r
"""


def build() -> dict[str, str]:
    return {"op5_warc": WARC, "op8_exact_topk": TOPK, "op10_embedding_dedup": EMBEDDING_DEDUP,
            "op11_fim": FIM, "op12_line_dedup": LINE_DEDUP, "op13_resampling": RESAMPLING}
