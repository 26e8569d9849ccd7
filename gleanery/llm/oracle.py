"""DuckDB SQL for the queries that SQL can express; each is written from the contract.

The turns of the sharding table follow each other one by one, which SQL expresses only by
copying the table for each turn; that query is tested against a brute-force version.
"""

OP6 = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('20:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM docs GROUP BY source
), total AS (SELECT 1.5::DOUBLE * sum(source_size) AS t FROM sources),
levels AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place, (t - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources, total
), chosen AS (
  SELECT coalesce(min_by(level, place) FILTER (level * weight <= 2.0::DOUBLE * source_size), 'inf'::DOUBLE) AS level FROM levels
), targets AS (
  SELECT source, source_size, least(weight * chosen.level, 2.0::DOUBLE * source_size) AS target FROM sources, chosen
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), keys AS (
  SELECT source, key, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY key) - sum(size) AS below FROM docs GROUP BY source, key
)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * (p.whole + CASE WHEN 2 * k.below + k.words <= 2 * (round(p.target)::BIGINT - p.whole * p.source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
JOIN keys k ON k.source IS NOT DISTINCT FROM d.source AND k.key = d.key
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT payload, max(page_id) AS original FROM p GROUP BY payload)
SELECT p.page_id, strlen(p.payload)::BIGINT AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31) + 1, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN p.page_id = g.original OR g.original IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id = g.original THEN NULL ELSE g.original END AS refers_to
FROM p JOIN g ON p.payload = g.payload
"""

OP9 = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.ints, c.ints)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
) WHERE rank <= 10
"""

OP11 = r"""
WITH RECURSIVE bits AS (
  SELECT b::BIGINT AS b, b::BIGINT AS c, 0 AS step FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
), crc AS (SELECT list(c ORDER BY b) AS remainders FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), met AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT doc_id, run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten([CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)]::BIGINT[] END
                                              FOR ch IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')])),
    lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1]))) AS h
  FROM met, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), coded AS ( -- levenshtein counts bytes: U+00C0 to U+00FF become signs of one byte
  SELECT word, n, translate(word, (SELECT string_agg(chr((192 + i)::INT), '' ORDER BY i) FROM range(64) t(i)), (SELECT string_agg(chr((33 + i)::INT), '' ORDER BY i) FROM range(64) t(i))) AS one_byte FROM words
), near AS (
  SELECT a.word, a.n, count(*) AS n_near, min(struct_pack(less := -b.n, form := b.word)) AS best
  FROM coded a JOIN coded b ON abs(length(a.word) - length(b.word)) <= 1 AND a.word <> b.word
    AND levenshtein(a.one_byte, b.one_byte) = 1
  GROUP BY a.word, a.n
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.less >= 5 * w.n THEN best.form END AS form, CASE WHEN -best.less >= 5 * w.n THEN -best.less END::BIGINT AS form_n
  FROM words w LEFT JOIN near USING (word)
), chains AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chains c ON c.word = f.word AND c.next IS NULL
"""

ORACLES = {"op6_mixing": OP6, "op7_warc": OP7, "op9_topk": OP9, "op11_spelling": OP11}
