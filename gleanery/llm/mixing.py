"""Mixing sources to target weights by capped water-filling.

Every source should supply its weight's share of the mix, but at most ``max_epochs``
times its own size. Sources above that are clamped, their excess goes to the others in
proportion to their weights, and so on until no source is above. A source's documents
are then taken in whole repetitions, and for the remaining fraction in a seeded order
up to the quota.

Only sums move: one row for each source, and for each source and bucket of the seeded
order. The bucket in which a source's quota ends is cut into smaller ones until few
documents are left to put in order, so a hot source is never in one task. The outcome is a small plan, one row for each source; applying it
to documents needs no further shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm import common
from gleanery.session import written

SEED = 20
DIGITS, LEVELS = 2, 3  # the order's hexadecimal digits are looked at two at a time, three times


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def seeded(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))


def measured(documents: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return documents.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"), seeded(F.col(id_col), seed).alias("key"))


def ranked(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sources in order of code points, null last, with the repeating weights.

    Ranks are counted within ranges and offset by the ranges before, so that no task
    gets all sources.
    """
    ranges = written(
        sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix-sources"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("part").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    place = (F.col("offset") + F.col("inside") - 1) % len(weights)
    out = ranges.withColumn("inside", inside).join(F.broadcast(offsets.select("part", "offset")), "part")
    return out.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))).select("source", "source_size", "weight")


def water_filled(sources: DataFrame, total_share: float, max_epochs: float) -> DataFrame:
    """Adds ``target``. Each round is one sum over the sources that are not clamped yet."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = None  # target of a source of weight 1; the clamped are those above their cap at some round
    clamped = F.lit(False)
    whole = sources.agg(F.sum("source_size").alias("s")).head()[0] or 0
    total = min(total_share, max_epochs) * whole
    while True:
        row = sources.select(F.col("weight"), cap.alias("cap"), clamped.alias("clamped")).agg(
            F.sum(F.when(F.col("clamped"), F.col("cap")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(~F.col("clamped"), F.col("weight")).otherwise(0.0)).alias("weight"),
            F.count(F.when(F.col("clamped"), 1)).alias("n"),
        ).head()
        if not row or not row["weight"]:
            level = float("inf")
            break
        new = (total - row["fixed"]) / row["weight"]
        # a level only rises, so a source above its cap stays above it
        if level is not None and row["n"] == before:
            break
        level, before = new, row["n"]
        clamped = F.col("weight") * F.lit(level) > cap
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def plan(rows: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), total_share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """One row for each source: size, target, whole repetitions and where the fraction ends.

    ``rows`` has ``source``, ``size`` and ``key``. A key takes part in the fraction if
    at least half of its words lie below the quota in the order of keys; the keys taken
    are then a prefix, up to ``last_key``. Rows with one key are taken together.
    """
    first = written(rows.groupBy("source", F.substring("key", 1, DIGITS).alias("bucket")).agg(F.sum("size").alias("size")), "mix-buckets")
    sizes = first.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = water_filled(written(ranked(sizes, weights), "mix-weights"), total_share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    quota = F.round(F.col("target")).cast("bigint") - F.col("whole") * F.col("source_size")
    sources = written(sources.withColumn("whole", whole).withColumn("quota", quota), "mix-targets")
    # narrow down where each quota ends: in one of 256 buckets, then in one of 256 below it
    ends = sources.filter("quota > 0").select(F.col("source").alias("s"), "quota", F.lit("").alias("end"), F.lit(0).cast("bigint").alias("from"))
    for level in range(LEVELS):
        sums = first.join(ends, F.col("source").eqNullSafe(F.col("s"))) if level == 0 else (
            _inside(rows, ends).groupBy("s", "quota", "from", F.substring("key", 1, DIGITS * (level + 1)).alias("bucket")).agg(F.sum("size").alias("size"))
        )
        below = F.col("from") + F.sum("size").over(Window.partitionBy("s").orderBy("bucket")) - F.col("size")
        last = F.max(F.struct("bucket", "below")).alias("at")  # the last that begins below the quota
        ends = sums.withColumn("below", below).filter("below < quota").groupBy("s", "quota").agg(last)
        ends = written(ends.select("s", "quota", F.col("at.bucket").alias("end"), F.col("at.below").alias("from")), "mix-ends")
    by_key = _inside(rows, ends).groupBy("s", "quota", "from", "key").agg(F.sum("size").alias("size"))
    start = F.col("from") + F.sum("size").over(Window.partitionBy("s").orderBy("key")) - F.col("size")
    last = by_key.withColumn("start", start).filter(2 * F.col("start") + F.col("size") <= 2 * F.col("quota"))
    last = last.groupBy(F.col("s").alias("l")).agg(F.max("key").alias("last_key"))
    out = sources.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").join(last, F.col("source").eqNullSafe(F.col("l")), "left")
    # where even the first key of the last bucket is too large, all before that bucket are taken
    return written(out.select("source", "source_size", "target", "whole", F.coalesce("last_key", "end").alias("last_key")), "mix-plan")


def _inside(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows of the bucket in which their source's quota ends."""
    return rows.join(ends, F.col("source").eqNullSafe(F.col("s")) & F.col("key").startswith(F.col("end")))


def repetitions(key: Column) -> Column:
    """How often a row is taken; its plan's columns stand beside it."""
    extra = F.coalesce(key <= F.col("last_key"), F.lit(False)).cast("bigint")
    return F.col("whole") + extra


def mix(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (5.0, 2.0, 1.0), total_share: float = 1.5, max_epochs: float = 2.0, seed: int = SEED) -> DataFrame:
    """For each row: the id, ``size``, ``source_size``, ``target``, ``taken``.

    A null source is a source of its own, last in the order of weights. A null or empty
    text has size 0. Repeated ids are taken together. Nothing else is looked at. The
    same rows and seed give the same mix.
    """
    rows = measured(documents, id_col, text_col, source_col, seed)
    rows = written(rows, "mix-rows")
    made = plan(rows, weights, total_share, max_epochs).withColumnRenamed("source", "s")
    out = rows.join(made, F.col("source").eqNullSafe(F.col("s")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (repetitions(F.col("key")) * F.col("size")).alias("taken"))


def mixed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (5.0, 2.0, 1.0), total_share: float = 1.5, max_epochs: float = 2.0, seed: int = SEED) -> DataFrame:
    """The mix itself: each row with all its columns, as often as it is taken."""
    rows = measured(documents, id_col, text_col, source_col, seed)
    made = plan(written(rows, "mix-rows"), weights, total_share, max_epochs)
    made = made.select(F.struct("source", "whole", "last_key").alias("mix_plan"))
    names = documents.columns
    inner = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("mix_row"), F.col(source_col).cast("string").alias("mix_source"), seeded(F.col(id_col), seed).alias("mix_key"))
    joined = inner.join(made, F.col("mix_source").eqNullSafe(F.col("mix_plan.source")))
    extra = F.coalesce(F.col("mix_key") <= F.col("mix_plan.last_key"), F.lit(False)).cast("int")
    times = F.array_repeat(F.lit(1), F.col("mix_plan.whole").cast("int") + extra)
    return joined.select("mix_row", F.explode(times)).select("mix_row.*")
