"""Distributions: mergeable quantile sketches, drift against a baseline, stratified samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.operators.quantiles import exact_quantiles
from gleanery.session import written

SKETCH_SIZE = 1024


def sketch(value: Column | str, size: int = SKETCH_SIZE) -> Column:
    """Aggregate to a KLL sketch of the values; its size does not grow with the rows. Nulls are passed over."""
    return F.kll_sketch_agg_double(F.col(value).cast("double") if isinstance(value, str) else value.cast("double"), F.lit(size))


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the rank of a sketch's quantile may lie from the one asked for, as a share of the rows (99 % of the time).

    Merging sketches of one size does not add to it.
    """
    return 2.296 / size**0.9021  # fixed values: the fit that the sketch's authors publish


def merged_quantiles(windows: DataFrame, column: str, probabilities: Mapping[str, float], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """Quantiles of any union of windows from their sketches, without the rows behind them."""
    merged = windows.groupBy(*by).agg(F.kll_merge_agg_double(column, F.lit(size)).alias("_s"))
    return merged.select(*by, *[F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(n) for n, p in probabilities.items()])


def _null_safe(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def stability_index(baseline: DataFrame, current: DataFrame, value: str, by: str, bins: int = 10) -> DataFrame:
    """``by, n, psi``: the population stability index of each group against the baseline.

    Cuts are the baseline's quantiles, found once; every group is then counted by bin in
    one aggregation. Half a row is added to each bin, so that empty ones count too. Null
    values are passed over, a null group is one like any other. No cuts without a
    baseline: then no rows.
    """
    steps = {f"c{i}": i / bins for i in range(1, bins)}
    found = exact_quantiles(baseline, value, steps).head()
    if found is None or found[0] is None:
        return current.select(by, F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("psi")).limit(0)
    cuts = sorted(set(found))
    place = sum(((F.col(value) > F.lit(c)).cast("int") for c in cuts), F.lit(0)).alias("bin")
    expected = {r["bin"]: r["n"] for r in baseline.where(F.col(value).isNotNull()).groupBy(place).agg(F.count("*").alias("n")).collect()}
    total, kinds = sum(expected.values()), range(len(cuts) + 1)
    counts = current.where(F.col(value).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), *[F.count(F.when(place == i, 1)).alias(f"n{i}") for i in kinds])
    terms = []
    for i in kinds:
        share = (F.col(f"n{i}") + 0.5) / (F.col("n") + 0.5 * len(kinds))
        base = (expected.get(i, 0) + 0.5) / (total + 0.5 * len(kinds))
        terms.append((share - base) * F.log(share / base))
    return counts.select(by, "n", sum(terms[1:], terms[0]).alias("psi"))


def ks_statistic(baseline: DataFrame, current: DataFrame, value: str, by: str) -> DataFrame:
    """``by, n, ks``: the two-sample Kolmogorov-Smirnov statistic of each group against the baseline.

    The largest gap between two step functions lies at a value of the group or just
    before one, so the baseline's running count is only needed there. Equal values are
    counted first; values are put in ranges over many tasks, running counts are made
    inside a range and begin at the sums of the ranges before it.
    """
    rows = baseline.select(F.lit(True).alias("base"), F.lit(None).cast(current.schema[by].dataType).alias("g"), F.col(value).cast("double").alias("v")).unionByName(
        current.select(F.lit(False).alias("base"), F.col(by).alias("g"), F.col(value).cast("double").alias("v"))
    ).where("v IS NOT NULL AND NOT isnan(v)")
    counts = rows.groupBy("base", "g", "v").agg(F.count("*").alias("c"))
    placed = written(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "ks-counts")
    sums = placed.groupBy("base", "g", "part").agg(F.sum("c").alias("held"))
    before = Window.partitionBy("base", "g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("base", "g")
    sums = written(sums.select("base", "g", "part", "held", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("less"), F.sum("held").over(whole).alias("n")), "ks-sums")
    base_n = sums.where("base").agg(F.sum("held")).head()[0] or 0
    # what the baseline holds below each range, also where it has none of its own in it
    base_parts = sums.where("base").select("part", "held")
    parts = placed.select("part").distinct().join(base_parts, "part", "left")
    below = parts.select("part", F.coalesce(F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base_less"))
    up_to = Window.partitionBy("part").orderBy("v")
    upto_v = F.coalesce(F.sum(F.when(F.col("base"), F.col("c"))).over(up_to.rangeBetween(Window.unboundedPreceding, 0)), F.lit(0))
    at_v = F.coalesce(F.sum(F.when(F.col("base"), F.col("c"))).over(Window.partitionBy("part", "v")), F.lit(0))
    own = Window.partitionBy("part", "g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    seen = placed.withColumn("base_to", upto_v).withColumn("base_at", at_v).where("NOT base").withColumn("own_to", F.sum("c").over(own))
    offsets = sums.where("NOT base").select(F.col("g").alias("_g"), F.col("part").alias("_part"), "less", "n")
    joined = seen.join(below, "part").join(offsets, (F.col("part") == F.col("_part")) & _null_safe("g", "_g"))
    base_to = (F.col("base_less") + F.col("base_to")) / F.lit(float(base_n or 1))
    base_before = (F.col("base_less") + F.col("base_to") - F.col("base_at")) / F.lit(float(base_n or 1))
    own_to, own_before = (F.col("less") + F.col("own_to")) / F.col("n"), (F.col("less") + F.col("own_to") - F.col("c")) / F.col("n")
    gap = F.greatest(F.abs(base_to - own_to), F.abs(base_before - own_before))
    return joined.groupBy(F.col("g").alias(by)).agg(F.max("n").alias("n"), F.max(gap).alias("ks"))


def stratified_sample(df: DataFrame, key: str, stratum: str, quotas: Mapping[object, int], weight: Column | None = None, default: int = 0) -> DataFrame:
    """Weighted sampling without replacement: exactly the quota of each stratum, or all of it.

    A row's number is u ** (1 / weight), u a hash of its key between 0 and 1, and the largest of a
    stratum are taken (ties by key); a row of twice the weight is twice as likely to come
    first. Each task keeps at most the largest quota of a stratum before the shuffle.
    Rows without a positive weight or without a key are never taken. Quotas are a few numbers, by the stratum's value.
    """
    digits = 13
    u = (F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, digits), 16, 10).cast("double") + 1.0) / float(16**digits + 1)
    w = weight.cast("double") if weight is not None else F.lit(1.0)
    most = max([default, *quotas.values()])
    quota = F.lit(default)
    for value, n in quotas.items():
        quota = F.when(F.col(stratum).eqNullSafe(F.lit(value)), n).otherwise(quota)
    order = Window.partitionBy(stratum).orderBy(F.col("_late"), F.col(key))
    rows = df.withColumn("_late", -F.log(u) / w).where((w > 0) & F.col(key).isNotNull())
    # the smallest of -ln(u) / w are the largest of u ** (1 / w)
    taken = rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most).where(F.col("_place") <= quota)
    return taken.drop("_late", "_place")
