"""Kept indexes: building, searching, taking over changes."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.operators import inference, keyword_search, sampling, sync, text_index, vector_index, vector_search
from gleanery.plans import answer
from test_search import brute, clustered, found, frame

ASK = dict(query_id="id", query_vector="v")


@pytest.mark.parametrize("slots", [4096, 0])
def test_all_cells_and_a_long_shortlist_are_exact(spark, tmp_path, monkeypatch, slots):
    monkeypatch.setattr(vector_index.engine, "SMALL_ROWS", slots)
    rows = clustered(n=300, copies=100)
    df = frame(spark, rows)
    vector_index.build_index(df, str(tmp_path), "id", "v", k=7, cells=9)
    hits = vector_index.search_index(df, str(tmp_path), 7, probes=9, shortlist=300, exclude_same=True, **ASK)
    assert found(hits) == brute(rows, 7, True)


def test_default_search_finds_most_and_compares_little(spark, tmp_path):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(40, 24)) * 4
    rows = middle[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 24))
    df = frame(spark, rows)
    model = vector_index.build_index(df, str(tmp_path), "id", "v")
    hits = vector_index.search_index(df, str(tmp_path), 5, exclude_same=True, **ASK)
    exact = vector_search.exact_search(df, df, 5, corpus_id="id", corpus_vector="v", exclude_same=True, **ASK)
    assert vector_search.search_recall(hits, exact).agg(F.avg("recall")).head()[0] >= 0.9
    assert vector_index.compared_share(df, str(tmp_path), query_vector="v") < 0.2
    assert len(model.centres) == 55


def test_only_wanted_cells_are_read(spark, tmp_path):
    df = frame(spark, clustered())
    vector_index.build_index(df, str(tmp_path), "id", "v", cells=8)
    one = vector_index.read_index(spark, str(tmp_path)).where("cell = 3").select("code")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "value" not in plan.split("ReadSchema")[1]


def test_changes_touch_their_cells_only(spark, tmp_path):
    rows = clustered(n=400, copies=50)
    old = frame(spark, rows).where("id % 10 <> 1")
    moved = rows.copy()
    moved[::20] = -moved[::20]
    new = frame(spark, moved).where("id % 10 <> 3")
    path = str(tmp_path)
    vector_index.build_index(old, path, "id", "v", cells=12)
    feed = sync.change_rows(sync.snapshot_diff(old, new, "id"), new, "id")
    for _ in range(2):  # the same feed again changes nothing
        vector_index.change_index(spark, path, feed, "id", "v")
        kept = {r.id: r.value for r in vector_index.read_index(spark, path).collect()}
        assert kept == {r.id: r.v for r in new.where("id <> 399").collect()}
    hits = vector_index.search_index(new, path, 5, probes=12, shortlist=400, exclude_same=True, **ASK)
    keep = [i for i in range(400) if i % 10 != 3]
    expected = brute(moved[keep], 5, True)
    assert found(hits) == {keep[q]: [keep[i] for i in items] for q, items in expected.items()}
    everything = new.select("id", F.lit("delete").alias("change_type"), F.lit(None).cast("array<float>").alias("v"))
    vector_index.change_index(spark, path, everything, "id", "v")
    assert vector_index.read_index(spark, path).count() == 0
    assert vector_index.search_index(new, path, 5, **ASK).count() == 0


def test_odd_rows_are_left_out(spark, tmp_path):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (None, [3.0, 1.0]), (6, [2.0, 1.0]), (7, [float("inf"), 1.0])]
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "id long, v array<float>, code string, cell int")
    vector_index.build_index(df, str(tmp_path), "id", "v")
    assert {r.id for r in vector_index.read_index(spark, str(tmp_path)).collect()} == {1, 6}
    assert found(vector_index.search_index(df.where("id = 1"), str(tmp_path), 5, **ASK)) == {1: [1, 6]}
    with pytest.raises(ValueError):
        vector_index.build_index(df.limit(0), str(tmp_path / "none"), "id", "v")


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000).selectExpr("id % 3000 as id", "id as n")
    one = sampling.smallest_marks(df.repartition(1), "id", 100).collect()
    many = sampling.smallest_marks(df.repartition(13, "n"), "id", 100).collect()
    assert one == many and len(one) == 100
    hot = spark.range(20000).selectExpr("if(id % 3 = 0, 7, id) as id", "'x' as n")
    assert len(sampling.smallest_marks(hot, "id", 50).collect()) == 50
    assert sampling.smallest_marks(df.limit(0), "id", 5).collect() == []


# -- keyword index


def texts(n=700, seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    chance = 1.0 / np.arange(1, 301)
    rows = [(f"d{i:04d}", " ".join(rng.choice(vocabulary, rng.integers(0, 60), p=chance / chance.sum()))) for i in range(n)]
    rows += [(f"e{i:04d}", "w0 w0 w1") for i in range(200)]  # copies: ties
    rows += [(f"f{i}", "w5 " * 30 + "w0") for i in range(8)]
    return [*rows, ("null", None), ("empty", ""), ("odd", "Ünï 中文 w7!")]


@pytest.mark.parametrize("block,slice_docs", [(128, 1 << 14), (4, 50)])
def test_kept_postings_give_the_hits_of_bm25(spark, tmp_path, monkeypatch, block, slice_docs):
    monkeypatch.setattr(text_index, "BLOCK", block)
    monkeypatch.setattr(text_index, "SLICE_DOCS", slice_docs)
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in texts()], "chunk_id string, chunk_text string, term int, number string").repartition(5)
    queries = spark.createDataFrame([(1, "w0"), (2, "w5 w0 w1"), (3, "W250 w299 w0"), (4, None), (5, "unknown"), (6, "ünï 中文"), (7, "w5 w5 w40 w41 w42 w0")], "query_id int, text string")
    text_index.build_text_index(docs, str(tmp_path))
    for k in (1, 5, 30):
        kept = text_index.search_text_index(queries, str(tmp_path), k)
        direct = keyword_search.bm25_search(queries, docs, k)
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, direct.select(*kept.columns).collect()))
    if block < 128:
        assert text_index.read_share(queries, str(tmp_path), 1) < 0.5


def test_postings_and_texts_are_gone_through_once(spark, tmp_path, monkeypatch):
    passed, tokenised, asked_of, write = spark.sparkContext.accumulator(0), [], text_index._asked, text_index.written

    def counted(df):
        def run(batches):
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch

        return df.mapInArrow(run, df.schema)

    monkeypatch.setattr(text_index, "_asked", lambda *a: (lambda asked, postings: (asked, counted(postings)))(*asked_of(*a)))
    monkeypatch.setattr(text_index, "written", lambda df, purpose, *a: tokenised.append((purpose, df.columns)) or write(df, purpose, *a))
    docs = spark.createDataFrame(texts(), "chunk_id string, chunk_text string")
    queries = spark.createDataFrame([(1, "w0"), (2, "w5 w0 w1")], "query_id int, text string")
    text_index.build_text_index(docs, str(tmp_path))
    assert dict(tokenised)["text-index-numbered"] == ["id", "text", "number", "length"]  # no second pass for the lengths
    kept = text_index.search_text_index(queries, str(tmp_path), 5).collect()
    _, postings = asked_of(spark, str(tmp_path), queries, "query_id", "text")
    assert len(kept) == 10 and passed.value == postings.count()


def test_repeated_ids_and_null_rows_in_a_kept_index(spark, tmp_path):
    rows = [("a", "w1 w2"), ("a", "w1 w2"), ("b", "w1"), (None, "w1 w1"), ("c", None), ("d", ""), ("e", " ")]
    text_index.build_text_index(spark.createDataFrame(rows, "chunk_id string, chunk_text string").repartition(3), str(tmp_path))
    queries = spark.createDataFrame([(1, "w1 w2"), (2, ""), (None, "w1")], "query_id int, text string")
    hits = text_index.search_text_index(queries, str(tmp_path), 5).orderBy("rank").collect()
    assert [(r.query_id, r.item_id, r["rank"]) for r in hits] == [(1, "a", 1), (1, "a", 2), (1, "b", 3)]
    assert spark.read.parquet(f"{tmp_path}/totals").head()["n"] == 5


def test_numbers_are_packed_and_unpacked():
    rng = np.random.default_rng(1)
    values = np.concatenate([[0, 1, 127, 128, 16383, 16384, 2**35, 2**62 - 1, 2**49 - 1, 2**56 - 1, 2**56], rng.integers(0, 2**40, 1000)])
    assert (text_index.unpacked(text_index.packed(values)) == values).all()
    assert len(text_index.unpacked(b"")) == 0 and text_index.packed(np.zeros(0, np.int64)) == b""


def test_an_index_of_nothing(spark, tmp_path):
    docs = spark.createDataFrame([], "chunk_id string, chunk_text string")
    text_index.build_text_index(docs, str(tmp_path))
    queries = spark.createDataFrame([(1, "w0")], "query_id int, text string")
    assert text_index.search_text_index(queries, str(tmp_path), 3).collect() == []


def test_answers_from_kept_indexes(spark, tmp_path):
    embedder = inference.HashingEmbedder(16)
    rows = [(i, t, f"u/{i}", "T") for i, t in texts(100) if t]
    chunks = answer.embed_to_table(spark.createDataFrame(rows, "chunk_id string, chunk_text string, url string, title string"), "chunk_text", embedder, 16)
    text_index.build_text_index(chunks, f"{tmp_path}/t")
    vector_index.build_index(chunks, f"{tmp_path}/v")
    questions = spark.createDataFrame([(1, "w5 w0"), (2, "w7 w9 w11")], "query_id int, question string")
    hits = lambda search, **o: sorted(map(tuple, answer.retrieve(questions, chunks, embedder, 16, 5, search=search, **o).select("query_id", "item_id", "score", "rank").collect()))
    assert hits("keyword") == hits("keyword", text_path=f"{tmp_path}/t")
    assert len(hits("index", path=f"{tmp_path}/v", probes=4096, shortlist=1000)) == 10
    assert hits("index", path=f"{tmp_path}/v", probes=4096, shortlist=1000) == hits("exact")
    assert len(hits("hybrid", text_path=f"{tmp_path}/t", path=f"{tmp_path}/v")) == 10
    with pytest.raises(ValueError):
        hits("none")


def test_vectors_stay_clustered_however_short_the_means_are(spark, tmp_path):
    from gleanery.plans import catalog_search

    rng = np.random.default_rng(3)
    rows = []
    for label in range(4):
        half = rng.normal(size=(50, 64))
        for x in np.concatenate([half, -half]) + 0.01 * np.eye(64)[label]:  # the mean is all but zero
            rows.append((len(rows), (x / np.linalg.norm(x)).tolist(), label))
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: np.array(r.embedding) for r in catalog_search.clustered(spark, str(tmp_path)).collect()}
    unit = np.stack([got[i] / np.linalg.norm(got[i]) for i in range(len(rows))])
    same = np.array([r[2] for r in rows])
    likeness = unit @ unit.T
    assert likeness[same[:, None] == same].min() > 0.9


def test_the_index_needs_no_installed_package_on_the_workers(spark, monkeypatch):
    import pickletools

    model = vector_index.Model(np.eye(4), np.zeros((1, 256, 4)), 2, 20)
    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value))
    vector_index._coded(spark.range(1).selectExpr("id", "array(1f, 0f, 0f, 0f) AS value"), model)
    names = [str(arg) for _, arg, _ in pickletools.genops(__import__("pickle").dumps(sent[0]))]
    assert not any("gleanery" in n for n in names)


def test_a_slice_of_many_rare_words_is_packed_in_a_few_calls(monkeypatch):
    calls, pack = [], text_index._packed
    monkeypatch.setattr(text_index, "_packed", lambda values: calls.append(len(values)) or pack(values))
    n = 3000  # each word in one document, and one in all
    at, numbers = [x for i in range(n) for x in (i, n)], [7 + i // 2 for i in range(2 * n)]
    rows = [r for part in text_index._blocks_of([f"w{i}" for i in range(n + 1)], at, numbers, [1] * (2 * n), [2] * (2 * n), 2.0, 1.2, 0.75) for r in part.to_pylist()]
    assert calls == [6 * n]
    assert len(rows) == n + -(-n // text_index.BLOCK)
    common = [r for r in rows if r["term"] == f"w{n}"]
    got = [x for r in common for x in (r["first"] + np.cumsum(text_index.unpacked(r["data"]).reshape(3, -1)[0])).tolist()]
    assert got == list(range(7, 7 + n)) and [r["block"] for r in common] == list(range(len(common)))


def _in_one_cluster(n=1500, seed=7):
    """Vectors around one direction: what a code is off along it is more than what tells them apart."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, 32))
    rows = 0.1 * rows / np.linalg.norm(rows, axis=1, keepdims=True)
    rows += 32**-0.5
    return rows


def test_codes_tell_vectors_around_one_direction_apart():
    rows = _in_one_cluster(3000)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    model = vector_index.Model(*vector_index.learn(unit, 20, 8), 20, 20)
    cells = model.cells_of(unit)
    codes = np.concatenate([cells.astype("<i4")[:, None].view(np.uint8), model.encode(unit, cells)], axis=1)
    shared = SimpleNamespace(value=(model.centres, model.books, model.probes, model.shortlist))
    scorer = vector_index.CodeScorer(shared, 20)
    asked = scorer.queries(pa.array(unit[:100].tolist()))
    scores = scorer.score(asked, slice(0, 100), scorer.corpus(pa.array([c.tobytes() for c in codes], pa.binary()), asked))
    true = (-unit[:100] @ unit.T).argsort(axis=1)[:, :6]
    near = (-scores).argsort(axis=1)[:, :41]
    assert np.mean([np.isin(t, n).mean() for t, n in zip(true, near, strict=True)]) > 0.9


def test_many_queries_give_the_hits_of_few(spark, tmp_path, monkeypatch):
    rows = np.concatenate([_in_one_cluster(600), np.repeat(_in_one_cluster(1, 8), 200, axis=0), -_in_one_cluster(200, 9)])  # a crowded cell too
    df = frame(spark, rows).withColumn("id", F.concat(F.lit("k"), "id"))
    queries = df.unionByName(spark.createDataFrame([("zero", [0.0] * 32), ("null", None), (None, [1.0] * 32)], "id string, v array<float>"))
    vector_index.build_index(df, str(tmp_path), "id", "v", cells=20)
    ask = lambda **o: sorted(map(tuple, vector_index.search_index(queries, str(tmp_path), 4, exclude_same=True, **ASK, **o).select("query_id", "item_id", "score", "rank").collect()))
    few = [ask(probes=p, shortlist=s) for p, s in ((3, 6), (7, 300))]
    sent = []
    by_id = type(df).repartitionById
    monkeypatch.setattr(type(df), "repartitionById", lambda self, n, column: sent.append((n, self)) or by_id(self, n, column))
    for name, value in (("engine.SMALL_ROWS", 60), ("MEET_NUMBERS", 1), ("TILE_NUMBERS", 1 << 12), ("BLOCK_MATCHES", 1)):
        monkeypatch.setattr(f"gleanery.operators.vector_index.{name}", value)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 100)
    many = [ask(probes=p, shortlist=s) for p, s in ((3, 6), (7, 300))]
    assert few == many and len(few[0]) > 3900
    for n, sides in sent:
        assert n > 3
        assert sides.where("kind = 0").count() == 1000  # a query travels once, not to each of its cells
        assert sides.where("kind = 1").count() < n * 1000
    held = {r.block: r["count"] for r in sent[0][1].where("kind = 0").groupBy("block").count().collect()}
    assert max(held.values()) <= 2 * 256


def test_copies_of_one_vector_are_not_all_scored_for_each_other(monkeypatch):
    rows = np.repeat(_in_one_cluster(3), 500, axis=0)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    model = vector_index.Model(*vector_index.learn(unit, 2, 8), 2, 20)
    cells = model.cells_of(unit)
    codes = np.concatenate([cells.astype("<i4")[:, None].view(np.uint8), model.encode(unit, cells)], axis=1)
    scorer = vector_index.CodeScorer(SimpleNamespace(value=(model.centres, model.books, model.probes, model.shortlist)), 2)
    ids, vectors = pa.array(np.arange(1500)), pa.array(unit.tolist())
    pairs, exact = [], vector_search.CosineScorer.exact
    monkeypatch.setattr(vector_search.CosineScorer, "exact", lambda self, q, r, c, col: pairs.append(len(r)) or exact(self, q, r, c, col))
    lists = vector_index.Shortlists(ids, vectors, scorer, 4, True)
    lists.meet(ids, vectors, pa.array([c.tobytes() for c in codes], pa.binary()))
    best = lists.best(2).to_pydict()
    assert sum(pairs) < 1500 * 40
    assert best["item_id"][:4] == [1, 2, 0, 2] and best["item_id"][-2:] == [1000, 1001] and set(best["score"]) == {1.0}


def test_neighbourhoods_hold_near_cells_and_no_more_than_they_may():
    centres = np.concatenate([np.eye(6)[i] + 0.01 * np.random.default_rng(i).normal(size=(5, 6)) for i in range(6)])
    weights = np.full(30, 10.0)
    weights[7] = 500.0
    group = vector_index.neighbourhoods(centres, weights, 50.0)
    assert np.flatnonzero(group == group[7]).tolist() == [7]
    others = [i for i in range(30) if not 5 <= i < 10]
    assert all(weights[group == g].sum() <= 50 for g in set(group[others])) and all(len(set(group[i * 5 : i * 5 + 5])) == 1 for i in (0, 2, 3, 4, 5))
    assert len(set(vector_index.neighbourhoods(np.zeros((4, 2)), np.ones(4), 1.0))) == 4


def test_a_change_shuffles_only_rows_that_may_have_changed(spark, tmp_path, monkeypatch):
    df = frame(spark, clustered(n=400, copies=50))
    vector_index.build_index(df, str(tmp_path), "id", "v", cells=12)
    kept = []
    monkeypatch.setattr(vector_index, "_write_cells", lambda rows, path, mode: kept.append(rows))
    vector_index.change_index(spark, str(tmp_path), df.where("id < 20").withColumn("change_type", F.lit("update")), "id", "v")
    ids = [r.id for r in kept[0].where("id IS NOT NULL").collect()]
    assert set(range(20)) <= set(ids) and len(ids) == len(set(ids))
    plan = kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "_word" in plan
