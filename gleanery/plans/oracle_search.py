"""The same results in ANSI SQL, for the queries of :mod:`catalog_search`."""

from __future__ import annotations

from gleanery.plans.oracle_text import DOCS, strip, windows, words

VECTORS = """v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e, label, 'label/' || label AS url
  FROM embeddings)"""
PAIRS = """s AS (
  SELECT a.id AS query_id, b.id AS item_id, round(list_cosine_similarity(a.e, b.e), 6) AS score
  FROM v a JOIN v b ON a.id <> b.id)"""


def best(source: str, k: int, name: str) -> str:
    return f"""{name} AS (
  SELECT query_id, item_id, rank, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM {source})
  WHERE rank <= {k})"""


# Buckets: the signs of dot products with hashed +1/-1 planes, six to a table, 57 tables.
HASHED = f"""planes AS (
  SELECT t, b, list(CASE WHEN substr(md5(t || '/' || b || '/' || i), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY i) AS p
  FROM range(57) ts(t), range(6) bs(b), range(64) ix(i) GROUP BY t, b),
buckets AS (
  SELECT id, t, sum(CASE WHEN list_inner_product(e, p) >= 0 THEN 1 << b ELSE 0 END) AS bucket
  FROM v, planes GROUP BY id, t),
met AS (
  SELECT DISTINCT a.id AS query_id, b.id AS item_id FROM buckets a JOIN buckets b
  ON a.t = b.t AND a.bucket = b.bucket AND a.id <> b.id),
hs AS (SELECT s.* FROM s JOIN met USING (query_id, item_id)),
{best('hs', 5, 'hashed')}"""

CELLED = f"""n_cells AS (SELECT greatest(1, floor(sqrt(count(*)) + 0.5::DOUBLE))::BIGINT AS n FROM v),
pivots AS (
  SELECT e, cell FROM (SELECT e, (row_number() OVER (ORDER BY md5(id::VARCHAR), id))::BIGINT AS cell FROM v), n_cells WHERE cell <= n),
near AS (
  SELECT id, cell, row_number() OVER (PARTITION BY id ORDER BY list_cosine_similarity(v.e, p.e) DESC, cell) AS r
  FROM v CROSS JOIN pivots p),
cf AS (
  SELECT s.* FROM s JOIN near q ON q.id = query_id AND q.r <= (SELECT ceil(n * 0.85::DOUBLE) FROM n_cells)
  JOIN near c ON c.id = item_id AND c.r = 1 AND c.cell = q.cell),
{best('cf', 5, 'celled')}"""

SCORED = f"""f AS (SELECT * FROM s WHERE score >= 0.2),
{best('f', 5, 'hits')},
golden AS (SELECT id AS query_id, CASE WHEN label = 0 THEN [] ELSE [url] END AS expected FROM v),
lists AS (SELECT query_id, list(url ORDER BY rank) AS retrieved FROM hits JOIN v ON v.id = item_id GROUP BY 1),
j AS (SELECT query_id, coalesce(retrieved, []) AS r, expected AS x FROM golden LEFT JOIN lists USING (query_id)),
scored AS (
  SELECT query_id, len(r)::BIGINT AS n_retrieved,
         CASE WHEN len(r) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(r, x))::DOUBLE / len(r) END AS p,
         CASE WHEN len(x) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(r, x))::DOUBLE / len(x) END AS c
  FROM j)"""
RETRIEVAL_EVAL = f"""WITH {VECTORS}, {PAIRS}, {SCORED}
SELECT query_id, n_retrieved, round(p, 6) AS precision_at_k, round(c, 6) AS recall_at_k FROM scored"""

BM25 = f"""d AS (SELECT doc_id, {words('text')} AS w FROM documents),
n AS (SELECT count(*)::DOUBLE AS n, avg(len(w)) AS mean_length FROM d),
tf AS (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM d),
tfs AS (SELECT doc_id, dl, term, count(*)::DOUBLE AS tf FROM tf GROUP BY ALL),
df AS (SELECT term, count(*)::DOUBLE AS df FROM tfs GROUP BY 1),
q AS (SELECT DISTINCT item_id AS query_id, unnest({words('text')}) AS term FROM benchmark),
bm AS (
  SELECT query_id, doc_id AS item_id,
         round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
               / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / mean_length))), 6) AS score
  FROM q JOIN df USING (term) JOIN tfs USING (term), n GROUP BY 1, 2)"""


def hashed_vectors(source: str, key: str, text: str, name: str) -> str:
    """Signed counts of hashed words as (key, bucket, x)."""
    return f"""{name}_w AS (SELECT {key} AS id, unnest({words(text)}) AS w FROM {source}),
{name}_s AS (
  SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS b,
         CASE WHEN substr(md5(w), 9, 1) < '8' THEN 1 ELSE -1 END AS s FROM {name}_w),
{name} AS (SELECT id, b, sum(s)::DOUBLE AS x FROM {name}_s GROUP BY 1, 2),
{name}_n AS (SELECT id, sqrt(sum(x * x)) AS norm FROM {name} GROUP BY 1 HAVING sum(x * x) > 0)"""


def hashed_cosines(name: str) -> str:
    """Pairs without any common bucket score 0."""
    return f"""{name}_dot AS (
  SELECT q.id AS query_id, c.id AS item_id, sum(q.x * c.x) AS dot FROM qv q JOIN cv c ON q.b = c.b GROUP BY 1, 2),
{name} AS (
  SELECT q.id AS query_id, c.id AS item_id, round(coalesce(dot, 0) / (q.norm * c.norm), 6) AS score
  FROM qv_n q CROSS JOIN cv_n c LEFT JOIN {name}_dot d ON d.query_id = q.id AND d.item_id = c.id)"""


CONTEXTS = f"""{best('bm', 3, 'h')},
ctx AS (
  SELECT query_id, string_agg('[' || rank || '] Source: '
           || CASE WHEN source IN ('src1', 'src2') THEN 'unknown source' ELSE 'doc/' || item_id END
           || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS context
  FROM h JOIN documents ON doc_id = item_id GROUP BY 1)"""

ORACLES = {
    "vector_topk_odd": f"""WITH {VECTORS.replace("FROM embeddings)", "FROM embeddings WHERE vec_id % 50 NOT IN (7, 8, 9, 10))")},
{PAIRS}, {best('s', 5, 'h')}
SELECT * FROM h""",
    "search_coverage": """SELECT count(*) AS n_rows, count(*) FILTER (vec_id % 50 = 7) AS null_vectors,
       count(*) FILTER (vec_id % 50 IN (8, 10)) AS non_finite_vectors, count(*) FILTER (vec_id % 50 = 9) AS zero_vectors,
       count(*) FILTER (vec_id % 50 NOT IN (7, 8, 9, 10)) AS searchable
FROM embeddings""",
    "embed_failures": """SELECT doc_id, length(text) % 7 <> 0 AS embedded, length(text) % 7 = 0 AS failed FROM documents""",
    "vector_topk": f"WITH {VECTORS}, {PAIRS}, {best('s', 5, 'h')} SELECT * FROM h",
    "vector_topk_partitioned": f"WITH {VECTORS}, {PAIRS}, {best('s', 5, 'h')} SELECT * FROM h",
    "vector_topk_filtered": f"""WITH {VECTORS}, {PAIRS},
f AS (SELECT s.* FROM s JOIN v ON v.id = item_id WHERE label = 3 AND score >= 0.15), {best('f', 5, 'h')}
SELECT h.*, url FROM h JOIN v ON v.id = item_id""",
    "vector_hashed_topk": f"WITH {VECTORS}, {PAIRS}, {HASHED} SELECT * FROM hashed",
    "vector_celled_topk": f"WITH {VECTORS}, {PAIRS}, {CELLED} SELECT * FROM celled",
    "search_recall": f"""WITH {VECTORS}, {PAIRS}, {HASHED}, {CELLED}, {best('s', 5, 'h')},
found AS (SELECT 'hashed' AS search, query_id, item_id FROM hashed UNION ALL SELECT 'celled', query_id, item_id FROM celled),
r AS (
  SELECT k.search, h.query_id, count(x.item_id)::DOUBLE / count(*) AS recall
  FROM h CROSS JOIN (VALUES ('hashed'), ('celled')) k(search)
  LEFT JOIN found x ON x.search = k.search AND x.query_id = h.query_id AND x.item_id = h.item_id GROUP BY 1, 2)
SELECT search, query_id, round(recall, 6) AS recall, round(avg(recall) OVER (PARTITION BY search), 6) AS mean_recall FROM r""",
    "vector_index_kept": """SELECT count(*) AS index_rows, sum(vec_id)::BIGINT AS id_sum, count(*) FILTER (vec_id % 10 = 1) AS inserted,
       true AS recall_reached, true AS under_a_fifth_compared
FROM embeddings WHERE vec_id % 10 <> 3""",
    "retrieval_eval": RETRIEVAL_EVAL,
    "retrieval_eval_pairs": RETRIEVAL_EVAL,
    "retrieval_eval_mean": f"""WITH {VECTORS}, {PAIRS}, {SCORED}
SELECT count(*)::BIGINT AS questions, round(avg(p), 6) AS mean_precision_at_k,
       round(avg(c), 6) AS mean_recall_at_k FROM scored""",
    "keyword_bm25": f"WITH {BM25}, {best('bm', 5, 'h')} SELECT * FROM h",
    "keyword_bm25_partitioned": f"WITH {BM25}, {best('bm', 5, 'h')} SELECT * FROM h",
    "keyword_index": f"WITH {BM25}, {best('bm', 5, 'h')} SELECT * FROM h",
    "embed_hashing": f"""WITH {hashed_vectors('documents', 'doc_id', 'text', 'cv')},
full_ AS (
  SELECT doc_id, i, coalesce(x, 0)::BIGINT AS x
  FROM documents CROSS JOIN range(64) r(i) LEFT JOIN cv ON cv.id = doc_id AND cv.b = i)
SELECT doc_id, 64::BIGINT AS dimension, md5(string_agg(x::VARCHAR, ',' ORDER BY i)) AS vector_md5,
       1::BIGINT AS embedded FROM full_ GROUP BY 1""",
    "embed_changed": f"""WITH {hashed_vectors('documents', 'doc_id', 'text', 'cv')},
n AS (
  SELECT count(DISTINCT text) FILTER (doc_id % 4 <> 0) AS before,
         count(DISTINCT text) FILTER (doc_id % 4 = 0 AND text NOT IN (SELECT text FROM documents WHERE doc_id % 4 <> 0)) AS after FROM documents),
full_ AS (
  SELECT doc_id, i, coalesce(x, 0)::BIGINT AS x
  FROM documents CROSS JOIN range(64) r(i) LEFT JOIN cv ON cv.id = doc_id AND cv.b = i)
SELECT doc_id, md5(string_agg(x::VARCHAR, ',' ORDER BY i)) AS vector_md5, any_value(before) AS calls_before, any_value(after) AS calls_after
FROM full_, n GROUP BY 1""",
    "hybrid_rrf": f"""WITH {BM25}, {best('bm', 10, 'kw')},
{hashed_vectors('documents', 'doc_id', 'text', 'cv')},
{hashed_vectors('benchmark', 'item_id', 'text', 'qv')},
{hashed_cosines('cs')}, {best('cs', 10, 'dense')},
parts AS (
  SELECT query_id, item_id, 1::DOUBLE / (60 + rank) AS part FROM kw UNION ALL
  SELECT query_id, item_id, 1::DOUBLE / (60 + rank) FROM dense),
fused AS (SELECT query_id, item_id, round(sum(part), 6) AS score FROM parts GROUP BY 1, 2),
{best('fused', 5, 'h')} SELECT * FROM h""",
    "rerank_lexical": f"""WITH {BM25}, {best('bm', 20, 'c')},
t AS (
  SELECT query_id, c.item_id, list_distinct({words('b.text')}) AS qw, {words('d.text')} AS dw
  FROM c JOIN benchmark b ON b.item_id = query_id JOIN documents d ON d.doc_id = c.item_id),
r AS (
  SELECT query_id, item_id, round(CASE WHEN len(qw) = 0 THEN 0.0::DOUBLE
         ELSE len(list_intersect(qw, dw))::DOUBLE / len(qw) END, 6) AS score FROM t),
{best('r', 5, 'h')} SELECT * FROM h""",
    "rerank_closeness": f"""WITH {BM25}, {best('bm', 20, 'c')},
t AS (
  SELECT query_id, c.item_id, list_distinct({words('b.text')}) AS qw, {words('d.text')} AS dw
  FROM c JOIN benchmark b ON b.item_id = query_id JOIN documents d ON d.doc_id = c.item_id),
places AS (SELECT query_id, item_id, unnest(dw) AS word, unnest(range(len(dw))) AS pos FROM t),
occ AS (SELECT p.* FROM places p JOIN t USING (query_id, item_id) WHERE list_contains(qw, word)),
present AS (SELECT query_id, item_id, word FROM occ GROUP BY ALL),
asked AS (
  SELECT o.query_id, o.item_id, o.pos AS st, p.word, min(CASE WHEN o.word = p.word THEN o.pos END) OVER (
    PARTITION BY o.query_id, o.item_id, p.word ORDER BY o.pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next
  FROM occ o JOIN present p ON o.query_id = p.query_id AND o.item_id = p.item_id),
reached AS (SELECT query_id, item_id, st, count(next) AS n, max(next) - st + 1 AS size FROM asked GROUP BY 1, 2, 3),
m AS (SELECT query_id, item_id, count(*) AS found FROM present GROUP BY 1, 2),
shortest AS (SELECT query_id, item_id, found, min(size) AS size FROM reached JOIN m USING (query_id, item_id) WHERE n = found GROUP BY 1, 2, 3),
r AS (
  SELECT query_id, t.item_id, round(coalesce((found::DOUBLE / len(qw) + found::DOUBLE / size) / 2, 0.0::DOUBLE), 6) AS score
  FROM t LEFT JOIN shortest USING (query_id, item_id)),
{best('r', 5, 'h')} SELECT * FROM h""",
    "hit_snippets": f"""WITH {BM25}, {best('bm', 3, 'h')}
SELECT query_id, item_id, rank, 'doc/' || item_id AS url, replace(substr(text, 1, 160), chr(10), ' ') AS snippet
FROM h JOIN documents ON doc_id = item_id""",
    "context_block": f"""WITH {BM25}, {CONTEXTS}
SELECT query_id, length(context)::BIGINT AS n_chars, md5(context) AS context_md5 FROM ctx""",
    "prompt_table": f"""WITH {BM25}, {CONTEXTS}
SELECT item_id AS query_id, 'Answer from the context only.' AS system,
       md5('Context from the test documents:' || chr(10) || coalesce(context, '') || chr(10) || chr(10)
           || 'Question: ' || text || chr(10) || chr(10)
           || 'Reply in a few sentences and give the number of each block you rely on, as in [2].') AS human_md5
FROM benchmark LEFT JOIN ctx ON query_id = item_id""",
    "batch_answers": f"""WITH {DOCS}, {windows('docs', 'chunks')},
{hashed_vectors('chunks', 'chunk_id', 'chunk_text', 'cv')},
{hashed_vectors('benchmark', 'item_id', 'text', 'qv')},
{hashed_cosines('cs')}, {best('cs', 5, 'h')},
a AS (
  SELECT query_id, string_agg(url, ',' ORDER BY rank) AS cited, min_by(chunk_text, rank) AS top
  FROM h JOIN chunks ON chunk_id = item_id GROUP BY 1)
SELECT item_id AS query_id,
       md5(coalesce({strip("string_split(top, chr(10) || chr(10))[1]")},
           'There is not enough information to answer that.')) AS answer_md5,
       1::BIGINT AS answered, md5(coalesce(cited, '')) AS cited_md5
FROM benchmark LEFT JOIN a ON query_id = item_id""",
}
