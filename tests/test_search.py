from collections import Counter
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.operators import keyword_search, topk, vector_search


def clustered(n=600, dimension=16, centres=8, copies=200, seed=3):
    """Clusters, a third of all rows as copies of one vector, and one row without length."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dimension)) * 4
    rows = middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dimension))
    rows[:copies] = rows[0]
    rows[n - 1] = 0
    return rows


def frame(spark, rows, text_ids=False):
    ids = [f"id{i:04d}" if text_ids else i for i in range(len(rows))]
    return spark.createDataFrame(
        list(zip(ids, rows.astype(np.float32).tolist())),
        f"id {'string' if text_ids else 'long'}, v array<float>",
    )


def brute(rows, k, exclude_same=False, floor=None):
    rows = rows.astype(np.float32).astype(np.float64)
    norm = np.linalg.norm(rows, axis=1)
    ok = norm > 0
    unit = rows / np.where(ok, norm, 1)[:, None]
    scores = np.round(unit @ unit.T, 6)
    out = {}
    for q in np.nonzero(ok)[0]:
        items = [i for i in np.nonzero(ok)[0] if not (exclude_same and i == q)]
        items = [i for i in items if floor is None or scores[q, i] >= floor]
        out[q] = sorted(items, key=lambda i: (-scores[q, i], i))[:k]
    return {q: v for q, v in out.items() if v}


def found(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.item_id)
    return out


ASK = dict(query_id="id", query_vector="v", corpus_id="id", corpus_vector="v")


@pytest.mark.parametrize("options", [
    {}, {"max_small_rows": 0, "cells": 12, "block_rows": 64}, {"max_small_rows": 0, "cells": 1, "block_rows": 1000},
])
@pytest.mark.parametrize("exclude_same,floor", [(False, None), (True, None), (True, 0.9)])
def test_exact_search(spark, options, exclude_same, floor):
    rows = clustered()
    df = frame(spark, rows).repartition(3)
    hits = vector_search.exact_search(df, df, 7, exclude_same=exclude_same, min_score=floor, **ASK, **options)
    assert found(hits) == brute(rows, 7, exclude_same, floor)


def test_a_small_corpus_goes_to_the_queries(spark):
    rows = clustered()
    df = frame(spark, rows)
    few = df.where("id < 50")
    hits = vector_search.exact_search(df.repartition(3), few, 7, exclude_same=True, max_small_rows=60, **ASK)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    want = {q: [i for i in v if i < 50][:7] for q, v in brute(rows, len(rows), True).items()}
    assert found(hits) == want


def test_exact_search_with_text_keys(spark):
    rows = clustered(90, copies=30)
    df = frame(spark, rows, text_ids=True)
    want = {f"id{q:04d}": [f"id{i:04d}" for i in v] for q, v in brute(rows, 3, True).items()}
    for options in ({}, {"max_small_rows": 0, "cells": 3, "block_rows": 20}):
        hits = vector_search.exact_search(df, df, 3, exclude_same=True, **ASK, **options)
        assert found(hits) == want


def test_routing_skips_far_cells(spark):
    rng = np.random.default_rng(0)
    rows = np.repeat(np.eye(8), 50, axis=0) + rng.normal(size=(400, 8)) * 0.01
    df = frame(spark, rows).select(F.col("id"), F.col("v").alias("value"))
    q, c = vector_search._exact_route(5, None, False, 16)(df, df)
    assert c.count() == 400
    pairs = q.groupBy("cell").agg(F.count("*").alias("q")).join(
        c.groupBy("cell").agg(F.count("*").alias("c")), "cell")
    assert pairs.agg(F.sum(F.col("q") * F.col("c"))).first()[0] < 400 * 400 / 4


def test_vectors_of_another_dimension_fail(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "id long, v array<float>")
    with pytest.raises(Exception, match="one dimension"):
        vector_search.exact_search(df.coalesce(1), df.coalesce(1), 1, **ASK).collect()


def test_hashed_search_finds_true_scores(spark):
    rows = clustered()
    df = frame(spark, rows)
    hits = vector_search.hashed_search(df, df, 5, 16, bits=4, tables=6, block_rows=100, exclude_same=True, **ASK)
    exact = vector_search.exact_search(df, df, 5, exclude_same=True, **ASK)
    unit = rows / np.maximum(np.linalg.norm(rows, axis=1), 1e-9)[:, None]
    for r in hits.collect():
        assert r.score == pytest.approx(unit[r.query_id] @ unit[r.item_id], abs=2e-6)
    recall = vector_search.search_recall(hits, exact).agg(F.avg("recall")).first()[0]
    assert recall > 0.9


def test_celled_search(spark):
    rows = clustered()
    df = frame(spark, rows)
    all_cells = vector_search.celled_search(df, df, 5, cells=6, probes=6, block_rows=100, exclude_same=True, **ASK)
    assert found(all_cells) == brute(rows, 5, True)
    few = vector_search.celled_search(df, df, 5, cells=12, probes=3, exclude_same=True, **ASK)
    exact = vector_search.exact_search(df, df, 5, exclude_same=True, **ASK)
    assert vector_search.search_recall(few, exact).agg(F.avg("recall")).first()[0] > 0.8


@pytest.mark.parametrize("search,options", [
    (vector_search.celled_search, {}), (vector_search.celled_search, {"cells": 30}), (vector_search.hashed_search, {"dimension": 24}),
    (vector_search.hashed_search, {"dimension": 24, "tables": 30}), (vector_search.hashed_search, {"dimension": 24, "bits": 2}),
])
def test_defaults_reach_the_recall_without_clusters(spark, search, options):
    df = frame(spark, np.random.default_rng(4).normal(size=(1200, 24)))
    exact = vector_search.exact_search(df, df, 5, exclude_same=True, **ASK)
    hits = search(df, df, 5, exclude_same=True, **options, **ASK)
    assert vector_search.search_recall(hits, exact).agg(F.avg("recall")).first()[0] >= 0.9
    assert search(df.limit(0), df, 5, **options, **ASK).count() == 0


def test_score_floor_numbers_again(spark):
    hits = spark.createDataFrame([(1, 5, 0.9, 1), (1, 6, 0.2, 2), (1, 7, 0.5, 3)], "query_id long, item_id long, score double, rank int")
    kept = vector_search.with_score_floor(hits, 0.5).orderBy("rank").collect()
    assert [(r.item_id, r.rank) for r in kept] == [(5, 1), (7, 2)]


def brute_bm25(queries, texts, k):
    docs = [keyword_search.words(t) for t in texts]
    mean = sum(map(len, docs)) / len(docs)
    df = Counter(w for d in docs for w in set(d))
    out = {}
    for q, text in queries.items():
        scored = []
        for i, d in enumerate(docs):
            tf, score = Counter(d), 0.0
            for w in sorted(set(keyword_search.words(text))):
                if tf[w]:
                    idf = math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5))
                    score += idf * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(d) / mean))
            if score > 0:
                scored.append((-round(score, 6), i))
        if scored:
            out[q] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("options", [{}, {"max_small_rows": 0, "slice_rows": 2}, {"max_small_rows": 4}])
def test_bm25(spark, options):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)]
    # "the" is in every text and a third of all texts are copies.
    texts = ["the " + " ".join(rng.choice(vocabulary, rng.integers(1, 30))) for _ in range(200)]
    texts[:70] = [texts[0]] * 70
    texts[100] = ""
    queries = {0: "the w1 w2 w1", 1: "W3, w4!", 2: "unknown", 3: "the", 4: "w59"}
    q = spark.createDataFrame(list(queries.items()), "query_id long, text string")
    d = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, chunk_text string").repartition(3)
    hits = keyword_search.bm25_search(q, d, 6, **options)
    assert found(hits) == brute_bm25(queries, texts, 6)


def test_bm25_reads_documents_once_for_all_slices(spark, monkeypatch):
    texts = [f"the w{i % 7} w{i % 11} x{i}" for i in range(90)]
    queries = {i: f"the w{i} x{i * 3}" for i in range(9)}
    q = spark.createDataFrame(list(queries.items()), "query_id long, text string")
    d = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, chunk_text string").repartition(3)
    passes, one = [], topk.topk
    monkeypatch.setattr(topk, "topk", lambda *a, **o: passes.append(1) or one(*a, **o))
    hits = keyword_search.bm25_search(q, d, 4, max_small_rows=0, slice_rows=2)
    assert found(hits) == brute_bm25(queries, texts, 4) and len(passes) == 1
    monkeypatch.setattr(topk, "SMALL_BYTES", keyword_search.TERM_BYTES * 7)  # now neither terms nor queries may be sent at once
    hits = keyword_search.bm25_search(q, d, 4, max_small_rows=0, slice_rows=2)
    assert found(hits) == brute_bm25(queries, texts, 4) and len(passes) > 2


def test_fusion(spark):
    kind = "query_id long, item_id long, rank int"
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], kind)
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], kind)
    rows = keyword_search.fuse_ranks([a, b], 3).orderBy("rank").collect()
    assert [r.item_id for r in rows] == [11, 10, 12]
    assert rows[0].score == pytest.approx(1 / 61 + 1 / 62, abs=1e-6)


def test_rerank(spark):
    c = spark.createDataFrame(
        [(1, 10, "red fox", "a blue fox", 9.0, 1), (1, 11, "red fox", "the red fox", 1.0, 2)],
        "query_id long, item_id long, query_text string, item_text string, score double, rank int",
    )
    rows = keyword_search.rerank(c, 2).orderBy("rank").collect()
    assert [(r.item_id, r.score) for r in rows] == [(11, 1.0), (10, 0.5)]
    rows = keyword_search.rerank(c, 1, scorer=lambda qs, ts: [float(len(t)) for t in ts]).collect()
    assert [(r.item_id, r.score) for r in rows] == [(11, 11.0)]


def test_size_check(spark):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "id long, value string")
    assert topk.is_small(df, 50, 5000)
    assert not topk.is_small(df, 49, 5000) and not topk.is_small(df, 50, 4999)


def test_shortest_window_by_hand():
    rng = np.random.default_rng(3)
    for _ in range(500):
        text = rng.choice(list("abcdef"), rng.integers(0, 14)).tolist()
        query = rng.choice(list("abcxy"), rng.integers(0, 4)).tolist()
        present = set(query) & set(text)
        sizes = [j - i for i in range(len(text)) for j in range(i + 1, len(text) + 1) if present <= set(text[i:j])]
        assert keyword_search.shortest_window(query, text) == (len(present), min(sizes) if present else 0)
    assert keyword_search.closeness(None, "a") == keyword_search.closeness("a", None) == 0.0
    assert keyword_search.closeness("a b", "B a x") == 1.0


def test_diverse_hits(spark):
    rows = [(1, "a", 0.9, "x y z"), (1, "b", 0.9, "x y z"), (1, "c", 0.8, "p q"), (1, "d", 0.7, "x y p"), (2, "e", 0.1, None), (2, "f", 0.1, "")]
    df = spark.createDataFrame(rows, "query_id int, item_id string, score double, item_text string")
    found = {(r.query_id, r["rank"]): (r.item_id, r.score) for r in keyword_search.diversify(df, 3, 0.5).collect()}
    assert found == {(1, 1): ("a", 0.45), (1, 2): ("c", 0.4), (1, 3): ("d", 0.1), (2, 1): ("e", 0.05), (2, 2): ("f", 0.05)}
    assert [r.item_id for r in keyword_search.diversify(df, 9, 1.0).where("query_id = 1").orderBy("rank").collect()] == ["a", "b", "c", "d"]


class Batches:
    """Stands for a DataFrame: what a task would send."""

    def __init__(self, schema):
        self.schema = schema

    def mapInArrow(self, run, schema):
        return run


def test_copies_for_many_cells_leave_in_portions(spark):
    rng = np.random.default_rng(0)
    rows = spark.createDataFrame([(0, [0.0])], "id bigint, value array<float>")
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(rng.normal(size=(2000, 64)).astype(np.float32).tolist())], names=["id", "value"])
    sent = list(vector_search._visit(Batches(rows.schema), lambda unit: np.ones((len(unit), 500), bool), 500)(iter([batch])))
    assert sum(b.num_rows for b in sent) == 2000 * 500
    assert max(b.num_rows for b in sent) * 64 <= vector_search.PORTION_NUMBERS
    grouped = list(vector_search._visit_groups(Batches(rows.schema), lambda unit: np.ones((len(unit), 500), bool), np.array([0, 100, 500]))(iter([batch])))
    assert sum(b.num_rows for b in grouped) == 2000 * 2  # once to each group, not to each cell


def test_small_blocks_grow_with_their_cell(spark):
    rng = np.random.default_rng(0)
    side = spark.createDataFrame([(0, i, rng.normal(size=4).tolist()) for i in range(800)], "cell int, id bigint, value array<double>")
    other = spark.createDataFrame(side.collect(), side.schema)
    schema = topk.hits_schema(side.schema["id"], side.schema["id"])
    hits = topk.blocked(side, other, vector_search.CosineScorer(), 1, None, True, schema, 10, 1000)
    assert hits.count() == 800 * topk.CELL_BLOCKS  # a hit of each block of the corpus; 80 blocks without growth


@pytest.mark.parametrize(("k", "floor", "same"), [(1, None, False), (5, None, True), (5, 0.3, True), (20, 0.1, False)])
def test_rough_scores_lose_no_match(k, floor, same):
    class Plain:
        def score(self, queries, rows, corpus):
            return queries[rows] @ corpus.T

    calls = []

    class Counted(vector_search.CosineScorer):
        def exact(self, queries, rows, corpus, columns):
            calls.append(len(rows))
            return super().exact(queries, rows, corpus, columns)

    rng = np.random.default_rng(k)
    rows = rng.normal(size=(3000, 16))
    rows[1000:1400], rows[50], rows[2990] = rows[0], 0, np.nan  # copies, no length, no numbers
    rows[1400:1500] = rows[1] * (1 + 1e-9 * rng.normal(size=(100, 16)))
    with np.errstate(invalid="ignore"):
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    ids = rng.permutation(3000)
    want, got = (topk._best(s, ids, rows, ids, rows, k, floor, same) for s in (Plain(), Counted()))
    table = lambda found: sorted(zip(*(x.tolist() for x in found), strict=True))
    assert table(got) == table(want)
    assert sum(calls) < 0.2 * 3000 * 3000
