import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators import inference
from gleanery.plans import answer

FAST = {"wait_min": 0.0, "wait_max": 0.0}


def test_batches_keep_order_and_size(spark):
    def fn(texts):
        assert len(texts) <= 150
        return [f"{t}/{len(texts)}" for t in texts]

    df = spark.range(400).coalesce(1).select(F.col("id").cast("string").alias("t"))
    rows = inference.map_in_batches(df, fn, ["t"], "o", T.StringType()).collect()
    assert [r.t for r in rows] == [str(i) for i in range(400)]
    assert {r.o.split("/")[1] for r in rows} == {"150", "100"}
    assert all(r.o.split("/")[0] == r.t and r.error is None for r in rows)


@pytest.mark.parametrize("failures,ok", [(3, True), (4, True), (99, False)])
def test_retry(spark, failures, ok):
    calls = []

    def flaky(texts):
        calls.append(1)
        if len(calls) <= failures:
            raise RuntimeError("busy")
        return [1.0] * len(texts)

    df = spark.range(2).coalesce(1).select(F.col("id").cast("string").alias("t"))
    rows = inference.map_in_batches(df, flaky, ["t"], "o", T.DoubleType(), **FAST).collect()
    assert [r.o for r in rows] == ([1.0, 1.0] if ok else [None, None])
    assert all((r.error is None) if ok else ("busy" in r.error) for r in rows)


def test_a_bad_text_fails_alone(spark):
    def picky(texts):
        if "7" in texts:
            raise ValueError("no sevens")
        return [[float(t), 1.0] for t in texts]

    df = spark.range(20).coalesce(1).select("id", F.col("id").cast("string").alias("t"))
    rows = inference.embed_texts(df, "t", picky, 2, latency="s", **FAST).collect()
    assert [r.id for r in rows] == list(range(20))
    assert [(r.vector is None, r.error is None, r.s is None) for r in rows] == [(i == 7, i != 7, i == 7) for i in range(20)]


def test_waits_grow_and_are_bounded():
    waits = []

    def fail():
        raise ValueError

    with pytest.raises(ValueError):
        inference.call_with_retry(fail, attempts=7, sleep=waits.append)
    assert waits == [1.0, 2.0, 4.0, 8.0, 10.0, 10.0]


def test_dimension_is_checked(spark):
    df = spark.createDataFrame([("a",)], "t string")
    row = inference.embed_texts(df, "t", lambda ts: [[0.0] * 3] * len(ts), 4, **FAST).first()
    assert row.vector is None and "dimension" in row.error


def test_hashing_embedder():
    a, b, c = inference.HashingEmbedder(32)(["red fox", "FOX, red!", "something else"])
    assert np.array_equal(a, b) and not np.array_equal(a, c) and len(a) == 32


def test_judges_of_your_own(spark):
    df = spark.createDataFrame([("yes",), ("no",)], "answer string")
    judged = inference.judge_answers(
        df, lambda answers: [{"safety": float(a == "yes"), "tone": 0.5} for a in answers], ["answer"], ["safety", "tone"]
    )
    assert {(r.answer, r.safety, r.tone) for r in judged.collect()} == {("yes", 1.0, 0.5), ("no", 0.0, 0.5)}


def test_answers_end_to_end(spark):
    embedder = inference.HashingEmbedder(256)
    texts = {"fox": "A red fox runs over the green field.", "sea": "The blue sea is deep and cold."}
    chunks = inference.embed_texts(
        spark.createDataFrame([(k, f"u/{k}", k, t) for k, t in texts.items()], "chunk_id string, url string, title string, chunk_text string"),
        "chunk_text", embedder, 256,
    )
    questions = spark.createDataFrame([(1, "How deep is the blue sea?"), (2, "!!!")], "query_id long, question string")
    rows = answer.answer_questions(
        questions, chunks, embedder, 256, inference.extractive_answers("No idea."), "Use the context.", k=1
    ).collect()
    got = {r.query_id: r for r in rows}
    assert got[1].answer == texts["sea"] and got[1].cited_urls == ["u/sea"] and got[1].latency_s >= 0
    assert got[2].answer == "No idea." and got[2].context == ""


def test_calls_in_flight_keep_rows_and_errors(spark):
    import time as clock

    def slow(texts):
        clock.sleep(0.1)
        if "bad" in texts:
            raise ValueError("refused")
        return [t.upper() for t in texts]

    rows = spark.createDataFrame([(i, "bad" if i == 17 else f"t{i}") for i in range(60)], "i int, t string").coalesce(1)
    out, took = [], []
    for side_by_side in (1, 8):
        made = inference.map_in_batches(rows, slow, ["t"], "u", T.StringType(), batch_size=1, attempts=1, in_flight=side_by_side)
        made.limit(1).collect()
        began = clock.perf_counter()
        out.append([tuple(r) for r in made.collect()])
        took.append(clock.perf_counter() - began)
    assert out[0] == out[1] and [r[0] for r in out[0]] == list(range(60))
    assert out[0][17][2:] == (None, "ValueError: refused") and out[0][18][2:] == ("T18", None)
    assert took[0] > 3 * took[1]


def test_retries_of_a_task_are_bounded(spark, tmp_path):
    def refuse(texts):
        with open(f"{tmp_path}/calls", "a") as f:
            f.write("x")
        raise ValueError("no")

    rows = spark.createDataFrame([(f"t{i}",) for i in range(20)], "t string").coalesce(1)
    for side_by_side in (1, 4):
        made = inference.map_in_batches(rows, refuse, ["t"], "u", T.StringType(), batch_size=1, attempts=5, wait_min=0, wait_max=0, in_flight=side_by_side, max_retries=7)
        assert made.where("error IS NOT NULL").count() == 20
        assert len((tmp_path / "calls").read_text()) == 27
        (tmp_path / "calls").write_text("")


def test_only_new_texts_are_embedded(spark, tmp_path):
    store = str(tmp_path / "store")

    def embed(texts):
        with open(f"{tmp_path}/calls", "a") as f:
            f.write("".join(f"{t}\n" for t in texts))
        if any(t.startswith("bad") for t in texts):
            raise ValueError("refused")
        return [[float(len(t)), 1.0] for t in texts]

    def run(rows, model="m/1"):
        (tmp_path / "calls").write_text("")
        df = spark.createDataFrame(rows, "content_hash int, t string")
        made = inference.embed_changed(df, "t", embed, 2, store, model, portion_rows=2, attempts=1).collect()
        return sorted((r.content_hash, r.t, r.vector and r.vector[0], r.error) for r in made), sorted((tmp_path / "calls").read_text().split())

    made, calls = run([(1, "a"), (2, "bb"), (3, "a"), (4, None), (5, "ccc")])
    assert made == [(1, "a", 1.0, None), (2, "bb", 2.0, None), (3, "a", 1.0, None), (4, None, None, None), (5, "ccc", 3.0, None)]
    assert calls == ["a", "bb", "ccc"]
    made, calls = run([(1, "bb"), (2, "dddd"), (3, "bad")])
    assert set(calls) == {"dddd", "bad"} and made == [(1, "bb", 2.0, None), (2, "dddd", 4.0, None), (3, "bad", None, "ValueError: refused")]
    assert run([(1, "a"), (2, "dddd")])[1] == []
    assert run([(1, "a")], "other")[1] == ["a"]
    assert run([])[0] == []


def test_portions_read_their_own_part_of_the_new_texts(spark, tmp_path, monkeypatch):
    parts, embed = [], inference.embed_texts
    monkeypatch.setattr(inference, "embed_texts", lambda part, *a, **o: parts.append(part) or embed(part, *a, **o))
    rows = [(i, f"t{i % 900}") for i in range(1000)] + [(1000, None), (1001, ""), (1001, ""), (None, "bad")]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)

    def short(texts):
        if "bad" in texts:
            raise ValueError("refused")
        return [[float(len(t))] for t in texts]

    out = inference.embed_changed(df, "text", short, 1, f"{tmp_path}/store", "m", portion_rows=150, attempts=1)
    counts = [p.count() for p in parts]
    assert len(parts) == 7 and sum(counts) == 902 and max(counts) < 250  # 900 texts, the empty and the bad one
    for p in parts:
        assert "GreaterThanOrEqual(content_hash," in p._jdf.queryExecution().executedPlan().toString()
    for file in parts[0].inputFiles():
        hashes = [r.content_hash for r in spark.read.parquet(file).collect()]
        assert hashes == sorted(hashes)
    assert sum("_text" in spark.read.parquet(f).columns for f in out.inputFiles()) == 0  # texts are not kept with their vectors
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()  # one scan for the errors of all portions
    got = sorted(map(str, map(tuple, out.collect())))
    assert got == sorted(map(str, ((i, t, None if t in (None, "bad") else [float(len(t))], "ValueError: refused" if t == "bad" else None) for i, t in rows)))


def test_portions_are_ranges_that_leave_nothing_out(spark):
    df = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).unionByName(spark.createDataFrame([("0" * 64,), ("f" * 64,), ("8" + "0" * 63,)], "h string"))
    for n in (1, 2, 3, 7):
        found = [r.h for i in range(n) for r in df.where(inference._portion("h", i, n)).collect()]
        assert sorted(found) == sorted(r.h for r in df.collect())
