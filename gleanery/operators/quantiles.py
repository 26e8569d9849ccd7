"""Exact quantiles with linear interpolation, safe for a group of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import written


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: Sequence[str] = (),
    max_group_rows: int = 1_000_000,
    cuts: int = 256,
) -> DataFrame:
    """One row per group with one column per named probability.

    The built-in exact percentile holds all distinct values of a group in one
    task. That is used while the largest group has at most ``max_group_rows``
    rows (counted first). Beyond it the values are ranked across many tasks.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    largest = rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if largest <= max_group_rows:
        return rows.groupBy(*by).agg(
            *[F.percentile("_v", F.lit(p)).alias(n) for n, p in probabilities.items()]
        )
    return ranked_quantiles(rows, probabilities, by, cuts)


def ranked_quantiles(
    rows: DataFrame, probabilities: dict[str, float], by: Sequence[str], cuts: int
) -> DataFrame:
    """Exact quantiles of ``_v`` without holding a group in one task.

    Equal values are counted first. A sketch per group gives cut points that
    split it into small ranges; the cuts only spread the work, so their error
    does not matter. They are written, because two evaluations of a sketch may
    differ. Range totals tell which ranges hold the wanted ranks, and only
    values of those ranges are put in order.
    """
    # As a struct the key joins null groups too, and exists without grouping.
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    rows = rows.select(key.alias("_k"), "_v")
    counted = rows.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_c"))
    steps = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    sketch = written(
        rows.groupBy("_k").agg(
            F.array_distinct(F.percentile_approx("_v", steps, F.lit(10 * cuts))).alias("_cuts"),
            F.count(F.lit(1)).alias("_n"),
        ),
        "cuts",
    )
    spot = F.aggregate(
        "_cuts", F.lit(0), lambda acc, c: acc + F.when(c < F.col("_v"), 1).otherwise(0)
    )
    placed = counted.join(sketch, "_k").select("_k", "_n", "_v", "_c", spot.alias("_r"))
    totals = placed.groupBy("_k", "_r").agg(F.sum("_c").alias("_t"), F.max("_n").alias("_n"))
    before = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0)))

    def place_of(p: float):
        return F.lit(p) * (F.col("_n") - 1)

    # At most two ranks per probability and group are left from here on.
    ranks = F.array_distinct(
        F.array(*[f(place_of(p)) for p in probabilities.values() for f in (F.floor, F.ceil)])
    )
    hit = ranges.select("_k", "_r", "_before", "_t", F.explode(ranks).alias("_rank")).where(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_t"))
    )
    inside = placed.join(hit.select("_k", "_r", "_before").distinct(), ["_k", "_r"])
    upto = Window.partitionBy("_k", "_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = inside.withColumn("_end", F.col("_before") + F.sum("_c").over(upto))
    found = ordered.join(hit.select("_k", "_r", "_rank"), ["_k", "_r"]).where(
        (F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_c"))
    )
    by_rank = found.groupBy("_k").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"),
        F.max("_n").alias("_n"),
    )
    out = []
    for name, p in probabilities.items():
        at = place_of(p)
        low, high = F.element_at("_at", F.floor(at)), F.element_at("_at", F.ceil(at))
        out.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return by_rank.select(*[F.col(f"_k.{b}").alias(b) for b in by], *out)
