"""Score answers and decide whether they are good enough."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators import evaluate


def assess(golden: DataFrame, hits: DataFrame, answers: DataFrame, key: str = "url") -> DataFrame:
    """One row: retrieval means, lexical judge means, latency, gate and diagnosis.

    ``golden`` holds ``query_id, expected_response, expected_urls``; ``answers``
    holds ``query_id, answer, context, latency_s``. A question without an answer
    counts as an empty one, a question without hits as one without relevant hits;
    neither has a latency.
    """
    retrieval = evaluate.mean_scores(evaluate.score_retrieval(golden, hits, key))
    judged = evaluate.lexical_judgements(
        golden.select("query_id", "expected_response").join(answers, "query_id", "left")
        .withColumn("answer", F.coalesce("answer", F.lit("")))
        .withColumn("context", F.coalesce("context", F.lit("")))
    )
    means = judged.agg(
        F.avg("lexical_groundedness").alias("groundedness_mean"),
        F.avg("lexical_correctness").alias("correctness_mean"),
    )
    shares = golden.select("query_id").join(evaluate.relevance_share(hits, 0.0), "query_id", "left")
    relevance = shares.agg(F.avg(F.coalesce("lexical_relevance", F.lit(0.0))).alias("relevance_mean"))
    metrics = evaluate.one_row(retrieval, means, relevance, evaluate.latency_stats(answers))
    found = evaluate.diagnosis(
        "mean_precision_at_k", "mean_recall_at_k", "groundedness_mean", "relevance_mean",
        "correctness_mean", "p50_seconds", "p90_seconds",
    )
    return evaluate.quality_gate(metrics).withColumn("diagnosis", found)
