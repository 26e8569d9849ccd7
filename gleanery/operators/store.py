"""A table of current rows in key buckets, brought up to date batch by batch.

A row's bucket is the hash of its key; a bucket is a partition of the table. A batch reads
and rewrites the buckets of its keys and no others. Every row of a bucket names the last
batch that the bucket has taken in, so a batch that comes again finds its buckets done and
changes nothing. Beside its rows a key keeps a marker with its version, also when it is
removed, so an older version that comes late is turned away.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.session import written

BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def newest_of_each(batch: DataFrame, key: str, version: str | None) -> DataFrame:
    """One row for each key: that of the highest version, of equal ones the one with the largest hash."""
    order = F.struct(F.col(version) if version else F.lit(0), F.xxhash64(*batch.columns))
    return batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), order).alias("_row")).select("_row.*")


def merge_batch(
    spark: SparkSession, path: str, keys: DataFrame, rows: DataFrame | Callable[[DataFrame], DataFrame], batch: int,
    key: str = "url", buckets: int = BUCKETS,
) -> None:
    """Take over one batch: ``keys`` (``key, version``, each key once) and the ``rows`` these keys now have.

    A key in ``keys`` loses all its earlier rows, unless a higher version of it is
    stored; one without ``rows`` is removed. Null keys belong to one key like any other. ``batch`` numbers must rise. The number of buckets is fixed
    by the first batch. Buckets are read, written aside and then put in place, so a call
    that failed may be repeated.

    Which keys the store takes is settled first. ``rows`` may be a function that makes the rows
    of these keys (``key, version``), so that none are made for keys that are turned away.
    """
    place = bucket_of(key, buckets).alias("bucket")
    taken = written(keys.select(key, F.col("version").cast("bigint").alias("version"), place), "store-keys")
    touched = [r[0] for r in taken.select("bucket").distinct().collect()]  # at most the buckets
    stored = None
    if touched and _exists(spark, path):
        stored = spark.read.parquet(path)
        done = stored.where(F.col("bucket").isin(touched)).groupBy("bucket").agg(F.max("last_batch").alias("last_batch")).where(F.col("last_batch") >= batch)
        skip = {r[0] for r in done.collect()}
        touched = [b for b in touched if b not in skip]
        taken, stored = (d.where(F.col("bucket").isin(touched)) for d in (taken, stored))
    if not touched:
        return
    if stored is not None:
        known = stored.where("row IS NULL").select(F.col(key).alias("_key"), F.col("version").alias("_stored"))
        taken = taken.join(known, F.col(key).eqNullSafe(F.col("_key")), "left").where("_stored IS NULL OR version >= _stored").drop("_key", "_stored")
        taken = written(taken, "store-taken")
    made = rows(taken.drop("bucket")) if callable(rows) else rows
    brought = taken.withColumn("row", F.lit(None).cast(made.schema.simpleString())).select(key, "version", "row", "bucket").unionByName(
        made.withColumn("row", F.struct(*made.columns)).select(F.col(key).alias("_key"), "row")
        .join(taken, F.col("_key").eqNullSafe(F.col(key)))
        .select(key, "version", "row", "bucket")
    )
    if stored is not None:
        gone = taken.select(F.col(key).alias("_key"))
        brought = stored.drop("last_batch").join(gone, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(brought)
    now = written(brought.withColumn("last_batch", F.lit(batch).cast("bigint")), "store-buckets")
    now.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """The current rows."""
    return spark.read.parquet(path).where("row IS NOT NULL").select("row.*")
