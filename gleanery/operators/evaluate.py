"""Retrieval scores, judge means, the quality gate and its diagnosis."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import scores
from gleanery.functions import text as X
from gleanery.operators.quantiles import exact_quantiles

# The gate's thresholds.
MIN_GROUNDEDNESS = 0.8
MIN_CORRECTNESS = 0.7
MAX_P90_SECONDS = 3.0


def retrieved_lists(hits: DataFrame, key: str = "url") -> DataFrame:
    """``query_id, retrieved``: the keys of each query's hits in rank order."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", F.col(key).alias("key"))))
    return hits.groupBy("query_id").agg(F.transform(pairs, lambda p: p["key"]).alias("retrieved"))


def score_retrieval(
    golden: DataFrame, hits: DataFrame, key: str = "url", expected: str = "expected_urls"
) -> DataFrame:
    """Precision and recall per question; a question without hits keeps its row."""
    joined = golden.join(retrieved_lists(hits, key), "query_id", "left")
    retrieved = F.coalesce("retrieved", F.array().cast("array<string>"))
    return joined.withColumns(
        {
            "retrieved": retrieved,
            "precision_at_k": scores.precision_at_k(retrieved, expected),
            "recall_at_k": scores.recall_at_k(retrieved, expected),
        }
    )


def score_retrieval_by_pairs(
    hits: DataFrame, expected: DataFrame, questions: DataFrame, key: str = "url"
) -> DataFrame:
    """The same scores where the expected set is too long for an array.

    ``expected`` holds distinct rows ``query_id, key``. Both tables meet on the
    pair, and only counts per question come out of each aggregation.
    """
    matched = hits.select("query_id", key).distinct().join(
        expected.select("query_id", key), ["query_id", key], "left_semi"
    )
    n_hits = matched.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"))
    n_retrieved = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_retrieved"))
    n_expected = expected.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_expected"))
    joined = questions
    for counts in (n_retrieved, n_expected, n_hits):
        joined = joined.join(counts, "query_id", "left")
    names = ("n_retrieved", "n_expected", "n_hits")
    joined = joined.withColumns({n: F.coalesce(n, F.lit(0)) for n in names})
    hit = F.col("n_hits").cast("double")
    return joined.withColumns(
        {
            "precision_at_k": F.when(F.col("n_retrieved") == 0, 0.0).otherwise(
                hit / F.nullif("n_retrieved", F.lit(0))
            ),
            "recall_at_k": F.when(F.col("n_expected") == 0, 1.0).otherwise(
                hit / F.nullif("n_expected", F.lit(0))
            ),
        }
    )


def mean_scores(scored: DataFrame) -> DataFrame:
    """One row with both means."""
    return scored.agg(
        F.count(F.lit(1)).alias("questions"),
        F.avg("precision_at_k").alias("mean_precision_at_k"),
        F.avg("recall_at_k").alias("mean_recall_at_k"),
    )


def latency_stats(runs: DataFrame, seconds: str = "latency_s") -> DataFrame:
    """One row: exact p50 and p90 with linear interpolation, and the mean."""
    quantiles = exact_quantiles(runs, seconds, {"p50_seconds": 0.5, "p90_seconds": 0.9})
    mean = runs.agg(F.avg(seconds).alias("mean_seconds"))
    return one_row(quantiles, mean)


def judge_means(judged: DataFrame, metrics: list[str]) -> DataFrame:
    """One row with the mean of each per-answer score."""
    return judged.agg(*[F.avg(m).alias(f"{m}_mean") for m in metrics])


def quality_gate(
    metrics: DataFrame,
    at_least: Mapping[str, float] | None = None,
    at_most: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add ``passed`` and ``failed_checks``; a missing metric fails its check."""
    at_least = (
        {"groundedness_mean": MIN_GROUNDEDNESS, "correctness_mean": MIN_CORRECTNESS}
        if at_least is None else at_least
    )
    at_most = {"p90_seconds": MAX_P90_SECONDS} if at_most is None else at_most
    failures = []
    for name, bound in at_least.items():
        value = F.col(name) if name in metrics.columns else F.lit(None).cast("double")
        failures.append(F.when(value.isNull() | (value < bound), F.lit(f"{name} < {bound}")))
    for name, bound in at_most.items():
        value = F.col(name) if name in metrics.columns else F.lit(None).cast("double")
        failures.append(F.when(value.isNull() | (value > bound), F.lit(f"{name} > {bound}")))
    failed = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    return metrics.withColumn("failed_checks", failed).withColumn("passed", F.size("failed_checks") == 0)


def require_passed(gated: DataFrame) -> DataFrame:
    """Make a job that reads ``gated`` fail unless every row passed."""
    reason = F.concat(F.lit("quality gate failed: "), F.array_join("failed_checks", "; "))
    checked = F.when(F.col("passed"), F.lit(True)).otherwise(F.raise_error(reason).cast("boolean"))
    return gated.withColumn("passed", checked)


def diagnosis(
    precision: Column | str, recall: Column | str, groundedness: Column | str,
    relevance: Column | str, correctness: Column | str, p50: Column | str, p90: Column | str,
    low: float = 0.5, high: float = 0.8, tail_ratio: float = 3.0,
) -> Column:
    """The likely cause behind a pattern of metrics; retrieval comes first."""
    p, r, g, rel, cor, mid, tail = (
        F.col(c) if isinstance(c, str) else c
        for c in (precision, recall, groundedness, relevance, correctness, p50, p90)
    )
    return (
        F.when((rel < low) & (cor < low), "retrieval failure")
        .when(r < low, "corpus gap or query mismatch")
        .when((p < low) & (r >= high), "relevant page buried in noise")
        .when((p >= high) & (r >= high) & (g < low), "answer not grounded in context")
        .when((rel >= high) & (cor < low), "generation failure")
        .when(rel < low, "embedding mismatch")
        .when(tail > tail_ratio * mid, "slow tail")
        .otherwise("no finding")
    )


def lexical_judgements(
    answers: DataFrame, answer: str = "answer", context: str = "context",
    expected: str | None = "expected_response",
) -> DataFrame:
    """Word-overlap stand-ins for a judge; no measure of meaning.

    ``lexical_groundedness`` is the share of answer tokens that the context
    holds, ``lexical_correctness`` the token F1 against the expected answer.
    """
    sides = {"_answer": answer, "_context": context, **({"_expected": expected} if expected else {})}
    read = answers.withColumns(
        {n: F.array_distinct(X.tokens(F.coalesce(c, F.lit("")))) for n, c in sides.items()}
    )
    out = {"lexical_groundedness": scores.token_share("_answer", "_context")}
    if expected:
        out["lexical_correctness"] = scores.token_f1("_answer", "_expected")
    return read.withColumns(out).drop(*sides)


def relevance_share(hits: DataFrame, floor: float) -> DataFrame:
    """Share of each query's hits whose score reaches the floor."""
    return hits.groupBy("query_id").agg(
        F.avg(F.when(F.col("score") >= floor, 1.0).otherwise(0.0)).alias("lexical_relevance")
    )


def append_flagged(golden: DataFrame, flagged: DataFrame, request: str = "request") -> DataFrame:
    """The golden set and the flagged rows whose request it does not hold yet.

    Of several flagged rows with one request the smallest is taken, so that the
    result does not depend on the order in which tasks finish.
    """
    rest = [c for c in golden.columns if c != request]
    one_each = flagged.groupBy(request).agg(F.min(F.struct(*rest)).alias("_row"))
    fresh = one_each.join(golden.select(request).distinct(), request, "left_anti")
    return golden.unionByName(fresh.select(request, "_row.*").select(*golden.columns))


def one_row(*tables: DataFrame) -> DataFrame:
    """Put tables of one row each side by side."""
    stacked = tables[0]
    for t in tables[1:]:
        stacked = stacked.unionByName(t, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
