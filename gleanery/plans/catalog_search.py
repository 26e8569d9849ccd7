"""Checked queries: vector, keyword and hybrid search, contexts, prompts, answers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import context, evaluate, inference, keyword_search, sync, text_index, vector_index, vector_search
from gleanery.plans import answer
from gleanery.plans.catalog_text import fixed_document_chunks, load, long
from gleanery.session import shared_dir, spread, written

DIMENSION = 64
SYSTEM = "Answer from the context only."
NO_ANSWER = "There is not enough information to answer that."


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as chunks of the page ``label/n``."""
    return load(spark, sf, "embeddings").select(
        "vec_id", "embedding", "label", F.concat(F.lit("label/"), F.col("label").cast("string")).alias("url")
    )


SAME = dict(query_id="vec_id", query_vector="embedding", corpus_id="vec_id", corpus_vector="embedding",
            exclude_same=True)


def _shown(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select("query_id", "item_id", long("rank").alias("rank"), "score", *more)


def vector_topk(spark, sf):
    v = vectors(spark, sf)
    return _shown(vector_search.exact_search(v, v, 5, **SAME))


def vector_topk_partitioned(spark, sf):
    """The way for many queries: routed cells, block against block."""
    v = vectors(spark, sf)
    hits = vector_search.exact_search(v, v, 5, cells=16, max_small_rows=0, block_rows=256, **SAME)
    return _shown(hits)


def vector_topk_filtered(spark, sf):
    """A metadata filter on the corpus before the search, a score floor in it."""
    v = vectors(spark, sf)
    corpus = v.where(F.col("label") == 3)
    hits = vector_search.exact_search(v, corpus, 5, min_score=0.15, **SAME)
    return _shown(vector_search.with_columns_of(hits, v, "vec_id", ["url"]), "url")


def odd_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors, some of them null, with a component that is no number, or without length."""
    v, kind = vectors(spark, sf), F.pmod("vec_id", F.lit(50))
    odd = (
        F.when(kind == 8, F.transform("embedding", lambda x, i: F.when(i == 3, F.lit(float("nan")).cast("float")).otherwise(x)))
        .when(kind == 9, F.transform("embedding", lambda x: F.lit(0).cast("float")))
        .when(kind == 10, F.transform("embedding", lambda x, i: F.when(i != 5, x)))
        .when(kind != 7, F.col("embedding"))
    )
    return v.withColumn("embedding", odd)


def vector_topk_odd(spark, sf):
    """Vectors that cannot be searched hide no others."""
    v = odd_vectors(spark, sf)
    return _shown(vector_search.exact_search(v, v, 5, **SAME))


def search_coverage(spark, sf):
    return vector_search.search_coverage(odd_vectors(spark, sf), "embedding")


def embed_failures(spark, sf):
    """A model that refuses some texts: these fail alone, all others get their vector."""
    embedder = inference.HashingEmbedder(DIMENSION)

    def picky(texts):
        if any(len(t) % 7 == 0 for t in texts):
            raise ValueError("refused")
        return embedder(texts)

    texts = spread(load(spark, sf, "documents").select("doc_id", "text"))
    done = inference.embed_texts(
        texts, "text", picky, DIMENSION, attempts=1, batch_size=20
    )
    return done.select(
        "doc_id", F.col("vector").isNotNull().alias("embedded"), F.col("error").isNotNull().alias("failed"),
    )


def _hashed(v: DataFrame) -> DataFrame:
    """As many bits and tables as find nine tenths of the neighbours among these vectors, which have few clusters."""
    return vector_search.hashed_search(v, v, 5, DIMENSION, bits=6, tables=57, **SAME)


def _celled(v: DataFrame) -> DataFrame:
    """The root of the row count as cells; the share of cells that finds nine tenths of the neighbours."""
    cells = max(1, math.floor(v.count() ** 0.5 + 0.5))
    return vector_search.celled_search(v, v, 5, cells=cells, probes=math.ceil(cells * 0.85), **SAME)


def vector_hashed_topk(spark, sf):
    return _shown(_hashed(vectors(spark, sf)))


def vector_celled_topk(spark, sf):
    return _shown(_celled(vectors(spark, sf)))


def search_recall(spark, sf):
    """Each query's recall by both approximate searches, and their means."""
    v = vectors(spark, sf)
    exact = written(vector_search.exact_search(v, v, 5, **SAME), "exact")
    out = None
    for name, hits in (("hashed", _hashed(v)), ("celled", _celled(v))):
        recall = written(vector_search.search_recall(hits, exact), "recall")
        mean = recall.agg(F.avg("recall")).head()[0]
        shown = recall.select(F.lit(name).alias("search"), "query_id", F.round("recall", 6).alias("recall"), F.round(F.lit(mean), 6).alias("mean_recall"))
        out = shown if out is None else out.unionByName(shown)
    return out


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors drawn towards the direction of their label's mean, so that they lie in clusters.

    A mean of many vectors is as short as its label says little, hence its direction.
    """
    v = vectors(spark, sf)
    means = v.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    means = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("mean"))
    length = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda s, m: s + m * m))
    drawn = F.zip_with("embedding", "mean", lambda x, m: (0.1 * x + F.coalesce(F.try_divide(m, length), m)).cast("float"))
    return v.join(F.broadcast(means), "label").select("vec_id", drawn.alias("embedding"))


def vector_index_kept(spark, sf):
    """An index of an old snapshot, brought up to date by the change feed alone, against exact search in the new one."""
    path, now = shared_dir(spark, "vector-index"), written(clustered(spark, sf), "vectors")
    kind = F.pmod("vec_id", F.lit(10))
    old = now.where(kind != 1).withColumn("embedding", F.when(kind == 2, F.reverse("embedding")).otherwise(F.col("embedding")))
    new = now.where(kind != 3)
    vector_index.build_index(old, path, "vec_id", "embedding")
    keys = written(sync.snapshot_diff(old, new, "vec_id"), "diff")
    changed = sync.KeyFilter(keys, "vec_id").rows(new, True)
    vector_index.change_index(spark, path, sync.change_rows(keys, changed, "vec_id"), "vec_id", "embedding")
    hits = vector_index.search_index(new, path, 5, query_id="vec_id", query_vector="embedding", exclude_same=True)
    recall = vector_search.search_recall(hits, vector_search.exact_search(new, new, 5, **SAME)).agg(F.avg("recall")).head()[0]
    share = vector_index.compared_share(new, path, query_vector="embedding")
    return vector_index.read_index(spark, path).agg(
        F.count("*").alias("index_rows"), F.sum("id").alias("id_sum"), F.count(F.when(F.pmod("id", F.lit(10)) == 1, 1)).alias("inserted"),
        F.lit(recall >= vector_search.RECALL).alias("recall_reached"), F.lit(share < 0.2).alias("under_a_fifth_compared"),
    )


def _golden(v: DataFrame) -> DataFrame:
    """Each vector asks for the page of its own label; label 0 stands for out of scope."""
    return v.select(
        F.col("vec_id").alias("query_id"),
        F.when(F.col("label") == 0, F.array().cast("array<string>")).otherwise(F.array("url")).alias("expected_urls"),
    )


def _scored(spark, sf) -> DataFrame:
    v = vectors(spark, sf)
    hits = vector_search.exact_search(v, v, 5, min_score=0.2, **SAME)
    named = vector_search.with_columns_of(hits, v, "vec_id", ["url"])
    return evaluate.score_retrieval(_golden(v), named)


def retrieval_eval(spark, sf):
    return _scored(spark, sf).select(
        "query_id", long(F.size("retrieved")).alias("n_retrieved"),
        F.round("precision_at_k", 6).alias("precision_at_k"), F.round("recall_at_k", 6).alias("recall_at_k"),
    )


def retrieval_eval_pairs(spark, sf):
    """The same scores from tables of pairs."""
    v = vectors(spark, sf)
    hits = vector_search.exact_search(v, v, 5, min_score=0.2, **SAME)
    named = vector_search.with_columns_of(hits, v, "vec_id", ["url"])
    expected = _golden(v).select("query_id", F.explode("expected_urls").alias("url"))
    scored = evaluate.score_retrieval_by_pairs(named, expected, v.select(F.col("vec_id").alias("query_id")))
    return scored.select(
        "query_id", long("n_retrieved").alias("n_retrieved"),
        F.round("precision_at_k", 6).alias("precision_at_k"), F.round("recall_at_k", 6).alias("recall_at_k"),
    )


def retrieval_eval_mean(spark, sf):
    m = evaluate.mean_scores(_scored(spark, sf))
    return m.select(long("questions").alias("questions"), *[F.round(c, 6).alias(c) for c in m.columns[1:]])


def _benchmark(spark, sf) -> DataFrame:
    return load(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _documents(spark, sf) -> DataFrame:
    return spread(load(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("chunk_text")))


def _bm25(spark, sf, k: int, **options) -> DataFrame:
    return keyword_search.bm25_search(_benchmark(spark, sf), _documents(spark, sf), k, **options)


def keyword_bm25(spark, sf):
    return _shown(_bm25(spark, sf, 5))


def keyword_bm25_partitioned(spark, sf):
    """The way for many queries: block against block."""
    return _shown(_bm25(spark, sf, 5, max_small_rows=0, slice_rows=15))


def keyword_index(spark, sf):
    """The same search from a kept inverted index."""
    path = shared_dir(spark, "text-index")
    text_index.build_text_index(_documents(spark, sf), path)
    return _shown(text_index.search_text_index(_benchmark(spark, sf), path, 5))


def embed_hashing(spark, sf):
    embedded = inference.embed_texts(
        _documents(spark, sf), "chunk_text", inference.HashingEmbedder(DIMENSION), DIMENSION
    )
    counts = F.transform("vector", lambda x: x.cast("int").cast("string"))
    return embedded.select(
        F.col("chunk_id").alias("doc_id"), long(F.size("vector")).alias("dimension"),
        F.md5(F.array_join(counts, ",")).alias("vector_md5"), F.col("error").isNull().cast("bigint").alias("embedded"),
    )


def embed_changed(spark, sf):
    """Two snapshots through one store: the second one calls for texts that the first did not have, each once."""
    store, embedder = shared_dir(spark, "embedded"), inference.HashingEmbedder(DIMENSION)
    docs = _documents(spark, sf)
    before = docs.where("chunk_id % 4 <> 0").unionByName(docs.where("chunk_id % 8 = 1"))
    inference.embed_changed(before, "chunk_text", embedder, DIMENSION, store, "hashing")
    first = spark.read.parquet(f"{store}/model=hashing").count()
    made = inference.embed_changed(docs, "chunk_text", embedder, DIMENSION, store, "hashing")
    counts = F.transform("vector", lambda x: x.cast("int").cast("string"))
    second = spark.read.parquet(f"{store}/model=hashing").count() - first
    return made.select(
        F.col("chunk_id").alias("doc_id"), F.md5(F.array_join(counts, ",")).alias("vector_md5"),
        long(F.lit(first)).alias("calls_before"), long(F.lit(second)).alias("calls_after"),
    )


def hybrid_rrf(spark, sf):
    embedder = inference.HashingEmbedder(DIMENSION)
    corpus = inference.embed_texts(_documents(spark, sf), "chunk_text", embedder, DIMENSION)
    asked = inference.embed_texts(_benchmark(spark, sf), "text", embedder, DIMENSION)
    dense = vector_search.exact_search(asked, corpus, 10)
    return _shown(keyword_search.fuse_ranks([_bm25(spark, sf, 10), dense], 5))


def _with_texts(spark, sf, hits: DataFrame) -> DataFrame:
    docs = spread(load(spark, sf, "documents")).select("doc_id", "text", F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"))
    return vector_search.with_columns_of(hits, docs, "doc_id", ["text", "url"])


def rerank_lexical(spark, sf):
    hits = _with_texts(spark, sf, _bm25(spark, sf, 20)).withColumnRenamed("text", "item_text")
    asked = _benchmark(spark, sf).withColumnRenamed("text", "query_text")
    return _shown(keyword_search.rerank(hits.join(asked, "query_id"), 5))


def rerank_closeness(spark, sf):
    hits = _with_texts(spark, sf, _bm25(spark, sf, 20)).withColumnRenamed("text", "item_text")
    asked = _benchmark(spark, sf).withColumnRenamed("text", "query_text")
    return _shown(keyword_search.rerank_by_closeness(hits.join(asked, "query_id"), 5))


def hit_snippets(spark, sf):
    hits = context.hit_list(_with_texts(spark, sf, _bm25(spark, sf, 3)), "text", 160)
    return hits.select("query_id", "item_id", long("rank").alias("rank"), "url", "snippet")


def _contexts(spark, sf) -> DataFrame:
    """Documents of two sources have no known address, to cover that case."""
    docs = load(spark, sf, "documents").select(
        "doc_id", "text", F.when(~F.col("source").isin("src1", "src2"), F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))).alias("url")
    )
    hits = vector_search.with_columns_of(_bm25(spark, sf, 3), docs, "doc_id", ["text", "url"])
    return context.context_blocks(hits, text="text")


def context_block(spark, sf):
    return _contexts(spark, sf).select(
        "query_id", long(F.length("context")).alias("n_chars"), F.md5("context").alias("context_md5")
    )


def prompt_table(spark, sf):
    questions = _benchmark(spark, sf).withColumnRenamed("text", "question")
    made = context.prompts(questions, _contexts(spark, sf), SYSTEM, subject="the test documents")
    return made.select("query_id", "system", F.md5("human").alias("human_md5"))


def batch_answers(spark, sf):
    """Questions, retrieval, prompt and a stand-in model, over chunks of all documents."""
    embedder = inference.HashingEmbedder(DIMENSION)
    chunks = answer.embed_to_table(fixed_document_chunks(spark, sf), "chunk_text", embedder, DIMENSION)
    questions = _benchmark(spark, sf).withColumnRenamed("text", "question")
    answers = answer.answer_questions(
        questions, chunks, embedder, DIMENSION, inference.extractive_answers(NO_ANSWER), SYSTEM
    )
    return answers.select(
        "query_id", F.md5("answer").alias("answer_md5"), F.col("error").isNull().cast("bigint").alias("answered"),
        F.md5(F.array_join("cited_urls", ",")).alias("cited_md5"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        vector_topk, vector_topk_partitioned, vector_topk_filtered, vector_topk_odd, search_coverage,
        embed_failures, vector_hashed_topk,
        vector_celled_topk, search_recall, vector_index_kept, retrieval_eval, retrieval_eval_pairs, retrieval_eval_mean,
        keyword_bm25, keyword_bm25_partitioned, keyword_index, embed_hashing, embed_changed, hybrid_rrf, rerank_lexical, rerank_closeness,
        hit_snippets, context_block, prompt_table, batch_answers,
    )
}
