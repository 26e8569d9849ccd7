"""Table checks, text statistics, and rollups of a request log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions import keys
from gleanery.functions import text as X
from gleanery.operators.quantiles import exact_quantiles


def duplicate_keys(df: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Keys that occur more than once."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1)


def duplicate_key_count(df: DataFrame, key: str = "chunk_id") -> DataFrame:
    """One row: rows, distinct keys, keys that occur more than once."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return counted.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("copies") > 1).alias("duplicate_keys"),
    )


def length_summary(df: DataFrame, text: str = "chunk_text") -> DataFrame:
    """One row: count, mean, min, quartiles and max of the text length.

    The exact percentile keeps one counter per distinct length, and chunks have
    no more distinct lengths than their maximum size.
    """
    n = F.length(text).cast("double")
    quartiles = {f"p{q}": F.percentile(n, F.lit(q / 100)) for q in (25, 50, 75)}
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.avg(n).alias("mean"), F.min(n).alias("min"),
        *[c.alias(name) for name, c in quartiles.items()], F.max(n).alias("max"),
    )


def text_statistics(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """Words, sentences, word length and a token estimate, per group.

    Sums are combined before the shuffle, so the size of a group does not matter.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = X.tokens(body)
    measured = df.select(
        *by,
        F.length(body).alias("chars"),
        F.size(found).alias("words"),
        F.greatest(F.regexp_count(body, F.lit(X.SENTENCE_END)), F.lit(1)).alias("sentences"),
        F.length(F.array_join(found, "")).alias("letters"),
    )
    return measured.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("words").alias("words"),
        F.sum("sentences").alias("sentences"),
        (F.sum("letters") / F.nullif(F.sum("words"), F.lit(0))).alias("letters_per_word"),
        (F.sum("words") / F.sum("sentences")).alias("words_per_sentence"),
        F.avg("chars").alias("mean_chars"),
        (F.sum("chars") / 4.0).alias("token_estimate"),
    )


def daily_rollup(
    log: DataFrame, ts: str, latency: str, answer_length: Column, refused: Column,
    by: Sequence[str] = (), max_group_rows: int = 1_000_000,
) -> DataFrame:
    """Requests, latency, answer length and refusal rate per day (and group)."""
    key = F.struct(F.to_date(ts).alias("day"), *by)  # a struct also joins null groups
    rows = log.select(
        key.alias("_k"), F.col(latency).alias("latency_s"),
        answer_length.alias("answer_length"), refused.cast("double").alias("refused"),
    )
    means = rows.groupBy("_k").agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg("latency_s").alias("mean_latency_s"),
        F.avg("answer_length").alias("mean_answer_length"),
        F.avg("refused").alias("refusal_rate"),
    )
    quantiles = exact_quantiles(
        rows, "latency_s", {"p50_latency_s": 0.5, "p90_latency_s": 0.9}, ["_k"], max_group_rows
    )
    return means.join(quantiles, "_k", "left").select("_k.*", "*").drop("_k")


def drift(rollup: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), day: str = "day") -> DataFrame:
    """Change of each metric against the previous day that has rows.

    Works on the rollup, which holds one row per day and group.
    """
    keys_ = list(by) or [F.lit(0)]
    previous = Window.partitionBy(*keys_).orderBy(day)
    out = {}
    for m in metrics:
        before = F.lag(m).over(previous)
        out[f"{m}_change"] = F.col(m) - before
        out[f"{m}_ratio"] = F.col(m) / F.nullif(before, F.lit(0.0))
    return rollup.withColumns(out)


def traffic_sample(log: DataFrame, key: str, share: float) -> DataFrame:
    """A repeatable share of the requests; the same key is always in or out."""
    return log.where(keys.in_sample(key, share))


def quarantine(df: DataFrame, text: str, patterns: Sequence[str] = X.INJECTION_PATTERNS) -> DataFrame:
    """Flag texts that try to give orders to a model. Rows are marked, not dropped:
    index those with ``quarantined = false`` and review the others."""
    return df.withColumn("quarantined", X.is_injection(text, patterns))
