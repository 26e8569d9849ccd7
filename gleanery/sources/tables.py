"""Tables: schemas, writes, previews and the late-schema log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names, types and nullability of the pipeline's tables.
BRONZE = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("content", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), True),
    ]
)
SILVER = T.StructType(
    [
        T.StructField("chunk_id", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("chunk_index", T.IntegerType(), False),
        T.StructField("chunk_text", T.StringType(), False),
    ]
)
GOLDEN = T.StructType(
    [
        T.StructField("request", T.StringType(), False),
        T.StructField("expected_response", T.StringType(), True),
        T.StructField("expected_urls", T.ArrayType(T.StringType()), True),
    ]
)


def golden_set(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """A hand-written evaluation set; URLs stay an array."""
    return spark.createDataFrame(list(rows), GOLDEN)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), count_rows: bool = False
) -> int | None:
    """Overwrite a Parquet table; on request count its rows in the same job.

    Rows are brought together by the partition columns before the write, so that
    not every task writes a file for every value. Spark sizes these groups at run
    time: a value that holds most rows is split, small ones share a task.
    """
    observation = Observation("rows")
    if count_rows:
        df = df.observe(observation, F.count(F.lit(1)).alias("n"))
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(path)
    return observation.get["n"] if count_rows else None


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log whose files gained columns over time."""
    return spark.read.option("mergeSchema", True).parquet(path)


def with_columns_present(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add each missing column as null, so a young log can be queried too."""
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def newest_rows(df: DataFrame, n: int = 5, by: str = "timestamp_ms", tie: str | None = None):
    """The ``n`` latest rows; unordered when the log has no such column yet."""
    if by not in df.columns:
        return df.limit(n)
    keys = [F.col(by).desc()] + ([F.col(tie)] if tie else [])
    return df.orderBy(*keys).limit(n)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
