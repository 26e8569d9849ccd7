import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleanery.operators import context, evaluate, monitor, quantiles
from gleanery.plans import assess
from gleanery.sources import tables

GOOD = {"groundedness_mean": 0.8, "correctness_mean": 0.7, "p90_seconds": 3.0}


@pytest.mark.parametrize("change,passed", [
    ({}, True),
    ({"groundedness_mean": 0.7999}, False),
    ({"correctness_mean": 0.6999}, False),
    ({"p90_seconds": 3.0001}, False),
    ({"groundedness_mean": None}, False),
    ({"p90_seconds": None}, False),
])
def test_gate(spark, change, passed):
    values = {**GOOD, **change}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} double" for n in values))
    row = evaluate.quality_gate(df).first()
    assert row.passed is passed and len(row.failed_checks) == (0 if passed else 1)


def test_gate_with_a_metric_left_out(spark):
    df = spark.createDataFrame([(0.9,)], "groundedness_mean double")
    row = evaluate.quality_gate(df).first()
    assert not row.passed and len(row.failed_checks) == 2
    with pytest.raises(Exception, match="quality gate failed"):
        evaluate.require_passed(evaluate.quality_gate(df)).collect()


def test_latency_follows_pandas(spark):
    values = [1.1, 2.7, 0.4, 9.3, 4.2]
    row = evaluate.latency_stats(spark.createDataFrame([(v,) for v in values], "latency_s double")).first()
    s = pd.Series(values)
    assert row.p50_seconds == pytest.approx(s.quantile(0.5))
    assert row.p90_seconds == pytest.approx(s.quantile(0.9))
    assert row.mean_seconds == pytest.approx(s.mean())


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_quantiles_both_ways(spark, by, limit):
    """A third of all rows in one group, half of them one value."""
    rng = np.random.default_rng(1)
    rows = [("hot", float(v)) for v in rng.exponential(size=700)] + [("hot", 2.5)] * 700
    rows += [(f"g{i % 9}", float(np.round(v, 1))) for i, v in enumerate(rng.normal(size=1400))]
    rows += [("single", 7.0), (None, 3.0), (None, 8.0), ("pair", 1.0), ("pair", 2.0)]
    df = spark.createDataFrame([*rows, ("hot", None)], "g string, v double").repartition(5)
    wanted = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.9, "e": 0.999, "f": 1.0}
    got = quantiles.exact_quantiles(df, "v", wanted, by, max_group_rows=limit, cuts=16)
    frame = pd.DataFrame(rows, columns=["g", "v"])
    groups = frame.groupby("g", dropna=False)["v"] if by else [(None, frame["v"])]
    want = {None if g != g else g: [s.quantile(p) for p in wanted.values()] for g, s in groups}
    out = {(r["g"] if by else None): [r[n] for n in wanted] for r in got.collect()}
    assert out.keys() == want.keys()
    for g in want:
        assert out[g] == pytest.approx(want[g])


def golden_and_hits(spark):
    golden = spark.createDataFrame(
        [(1, "exp one", ["u1"]), (2, "exp two", ["u2", "u3"]), (3, "none", [])],
        "query_id long, expected_response string, expected_urls array<string>",
    )
    hits = spark.createDataFrame(
        [(1, 10, 1, "u1", 0.9), (1, 11, 2, "u1", 0.8), (1, 12, 3, "u9", 0.1), (3, 13, 1, None, 0.5)],
        "query_id long, item_id long, rank int, url string, score double",
    )
    return golden, hits


def test_retrieval_scores_keep_questions_without_hits(spark):
    golden, hits = golden_and_hits(spark)
    scored = evaluate.score_retrieval(golden, hits).orderBy("query_id").collect()
    assert [(r.precision_at_k, r.recall_at_k) for r in scored] == [(pytest.approx(1 / 3), 1.0), (0.0, 0.0), (0.0, 1.0)]
    pairs = evaluate.score_retrieval_by_pairs(
        hits, golden.select("query_id", F.explode("expected_urls").alias("url")), golden.select("query_id")
    ).orderBy("query_id").collect()
    assert [(r.precision_at_k, r.recall_at_k) for r in pairs] == [(r.precision_at_k, r.recall_at_k) for r in scored]
    means = evaluate.mean_scores(evaluate.score_retrieval(golden, hits)).first()
    assert tuple(means) == (3, pytest.approx(1 / 9), pytest.approx(2 / 3))


def test_assess(spark):
    golden, hits = golden_and_hits(spark)
    answers = spark.createDataFrame(
        [(1, "exp one", "exp one context", 1.0), (2, "exp two", "exp two", 2.0), (3, "none", "none", 1.5)],
        "query_id long, answer string, context string, latency_s double",
    )
    row = assess.assess(golden, hits, answers).first()
    assert row.passed and row.groundedness_mean == 1.0 and row.correctness_mean == 1.0
    assert row.p50_seconds == 1.5 and row.questions == 3
    assert row.diagnosis == "no finding"


@pytest.mark.parametrize("values,cause", [
    ((0.9, 0.9, 0.9, 0.1, 0.1, 1, 1), "retrieval failure"),
    ((0.9, 0.1, 0.9, 0.9, 0.9, 1, 1), "corpus gap or query mismatch"),
    ((0.1, 0.9, 0.9, 0.9, 0.9, 1, 1), "relevant page buried in noise"),
    ((0.9, 0.9, 0.1, 0.9, 0.9, 1, 1), "answer not grounded in context"),
    ((0.9, 0.9, 0.9, 0.9, 0.1, 1, 1), "generation failure"),
    ((0.6, 0.6, 0.9, 0.1, 0.9, 1, 1), "embedding mismatch"),
    ((0.9, 0.9, 0.9, 0.9, 0.9, 1, 9), "slow tail"),
    ((0.9, 0.9, 0.9, 0.9, 0.9, 1, 2), "no finding"),
])
def test_diagnosis(spark, values, cause):
    names = "abcdefg"
    df = spark.createDataFrame([tuple(map(float, values))], ", ".join(f"{n} double" for n in names))
    assert df.select(evaluate.diagnosis(*names).alias("d")).first().d == cause


def test_lexical_judgements(spark):
    df = spark.createDataFrame(
        [("red fox", "the red dog", "a red fox"), ("", "x", "y"), (None, None, None)],
        "answer string, context string, expected_response string",
    )
    rows = evaluate.lexical_judgements(df).collect()
    assert [r.lexical_groundedness for r in rows] == [0.5, 0.0, 0.0]
    assert [r.lexical_correctness for r in rows] == [pytest.approx(0.8), 0.0, 0.0]


def test_append_flagged(spark):
    kind = "request string, expected_response string, expected_urls array<string>"
    golden = tables.golden_set(spark, [("q1", "a", ["u"]), ("q0", "a", [])])
    flagged = spark.createDataFrame([("q1", "z", ["w"]), ("q2", "y", []), ("q2", "b", ["v"])], kind)
    rows = evaluate.append_flagged(golden, flagged).collect()
    assert sorted(map(tuple, rows)) == [("q0", "a", []), ("q1", "a", ["u"]), ("q2", "b", ["v"])]


def hits(spark, rows):
    return spark.createDataFrame(rows, "query_id long, rank int, url string, chunk_text string")


def test_context_blocks(spark):
    df = hits(spark, [(1, 2, "https://b.com", "Second"), (1, 1, "https://a.com", "First"), (2, 1, None, "No url")])
    got = {r.query_id: r for r in context.context_blocks(df).collect()}
    assert got[1].context == "[1] Source: https://a.com\nFirst\n\n[2] Source: https://b.com\nSecond"
    assert got[1].cited_urls == ["https://a.com", "https://b.com"]
    assert got[2].context == "[1] Source: unknown source\nNo url"


def test_prompts(spark):
    questions = spark.createDataFrame([(1, "QUESTION"), (2, "other")], "query_id long, question string")
    contexts = context.context_blocks(hits(spark, [(1, 1, "u", "CONTEXT")]))
    got = {r.query_id: r for r in context.prompts(questions, contexts, "ONLY the context").collect()}
    assert got[1].system == "ONLY the context"
    assert got[1].human.index("CONTEXT") < got[1].human.index("QUESTION")
    assert got[2].context == "" and got[2].cited_urls == [] and "other" in got[2].human


def test_rollup_and_drift(spark):
    log = spark.createDataFrame(
        [("2024-01-01 10:00:00", 1.0, "abc", False), ("2024-01-01 11:00:00", 3.0, "a", True), ("2024-01-03 00:00:00", 4.0, "ab", False)],
        "ts string, s double, answer string, refused boolean",
    ).withColumn("ts", F.to_timestamp("ts"))
    rollup = monitor.daily_rollup(log, "ts", "s", F.length("answer"), F.col("refused"))
    rows = monitor.drift(rollup, ["mean_latency_s", "refusal_rate"]).orderBy("day").collect()
    assert [(r.requests, r.mean_latency_s, r.p50_latency_s, r.refusal_rate) for r in rows] == [(2, 2.0, 2.0, 0.5), (1, 4.0, 4.0, 0.0)]
    assert (rows[0].mean_latency_s_change, rows[1].mean_latency_s_change, rows[1].mean_latency_s_ratio) == (None, 2.0, 2.0)


def test_length_summary(spark):
    df = spark.createDataFrame([("x" * n,) for n in (1, 2, 3, 10)], "chunk_text string")
    row = monitor.length_summary(df).first()
    assert tuple(row) == (4, 4.0, 1.0, 1.75, 2.5, 4.75, 10.0)


def test_text_statistics(spark):
    df = spark.createDataFrame([("One two. Three!", "a"), (None, "a")], "t string, g string")
    row = monitor.text_statistics(df, "t", ["g"]).first()
    assert (row.n, row.words, row.sentences) == (2, 3, 3) and row.letters_per_word == pytest.approx(11 / 3)
