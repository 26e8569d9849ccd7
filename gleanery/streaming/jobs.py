"""Streams: corpus sync, log tail, monitoring windows, duplicate delivery."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gleanery.operators import distributions
from gleanery.operators import store as keyed
from gleanery.session import written


def with_trigger(writer, every: str | None):
    """Run once over what is there, or keep running every ``every``."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def read_file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder, with an explicit schema; of a table that is one file, this file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if glob is None and where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        folder, glob = where.getParent().toString(), where.getName()
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


# --- corpus sync ---------------------------------------------------------------
#
# A store is two append-only tables. ``chunks`` holds the chunks a batch made,
# ``pages`` one row per page the batch saw, with its version. The batch with a page's
# highest version, the later one among equals, replaces all its other chunks, also when
# it has fewer of them or none; a page marked as removed has none. Nothing old is
# rewritten, so a batch costs what it brings; a replayed batch overwrites only itself.


def sync_corpus(
    pages: DataFrame,
    to_chunks: Callable[[DataFrame], DataFrame],
    store: str,
    checkpoint: str,
    every: str | None = None,
    url: str = "url",
    newest_by: str | None = None,
    removed: str | None = None,
) -> StreamingQuery:
    """Chunk a stream of pages into ``store``.

    ``to_chunks`` maps pages to chunks with a ``url`` column. ``newest_by`` names
    the version that decides between copies of a page, within a batch and across
    batches; without it the later batch does. ``removed`` names a boolean column
    that is true where a page has left the source. Of equal versions in one batch one
    copy is taken, the same one on every run.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = keyed.newest_of_each(batch, url, newest_by)
        alive = fresh.where(~F.coalesce(F.col(removed), F.lit(False))) if removed else fresh
        to_chunks(alive).write.mode("overwrite").parquet(f"{store}/chunks/batch={batch_id}")
        # Written last: readers take a page's chunks from here on.
        version = (F.col(newest_by) if newest_by else F.lit(0).cast("bigint")).alias("version")
        fresh.select(url, version).distinct().write.mode("overwrite").parquet(f"{store}/pages/batch={batch_id}")

    writer = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def current_chunks(spark: SparkSession, store: str, url: str = "url") -> DataFrame:
    """The newest chunks of each page."""
    newest = spark.read.parquet(f"{store}/pages").groupBy(url).agg(
        F.max_by("batch", F.struct("version", "batch")).alias("batch")
    )
    return spark.read.parquet(f"{store}/chunks").join(newest, [url, "batch"]).drop("batch")


def sync_store(
    pages: DataFrame,
    to_chunks: Callable[[DataFrame], DataFrame],
    store: str,
    checkpoint: str,
    every: str | None = None,
    url: str = "url",
    newest_by: str | None = None,
    removed: str | None = None,
    buckets: int = keyed.BUCKETS,
) -> StreamingQuery:
    """Like :func:`sync_corpus`, into one table in buckets of the url that holds current chunks alone.

    A batch rewrites the buckets of its pages (:func:`gleanery.operators.store.merge_batch`);
    readers need no merge, and a batch that is replayed changes nothing. Pages that the store
    turns away are not chunked.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = written(keyed.newest_of_each(batch, url, newest_by), "sync-pages")
        alive = fresh.where(~F.coalesce(F.col(removed), F.lit(False))) if removed else fresh
        version = (F.col(newest_by) if newest_by else F.lit(0)).cast("bigint").alias("version")

        def chunks(taken: DataFrame) -> DataFrame:
            return to_chunks(alive.join(taken.select(F.col(url).alias("_taken")), F.col(url).eqNullSafe(F.col("_taken")), "left_semi"))

        keyed.merge_batch(batch.sparkSession, store, fresh.select(url, version), chunks, batch_id, url, buckets)

    writer = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def compact(spark: SparkSession, store: str, new_store: str, url: str = "url") -> None:
    """Write the current state as the base of a new store; batches follow it."""
    current_chunks(spark, store, url).write.mode("overwrite").parquet(f"{new_store}/chunks/batch=-1")
    spark.read.parquet(f"{store}/pages").groupBy(url).agg(F.max("version").alias("version")).write.mode(
        "overwrite"
    ).parquet(f"{new_store}/pages/batch=-1")


# --- request log -----------------------------------------------------------------


def tail_log(log: DataFrame, sink: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append new log rows to a table."""
    writer = log.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return with_trigger(writer.option("path", sink), every).start()


def monitor_windows(
    log: DataFrame, ts: str, latency: str, refused: Column, by: Sequence[str] = (),
    window: str = "1 day", lateness: str = "1 hour",
) -> DataFrame:
    """Requests, mean latency and refusal rate per closed window.

    The state per window and group is a few sums. Rows later than ``lateness``
    are dropped; the query's progress reports their number.
    """
    rows = log.select(
        F.col(ts).cast("timestamp").alias("ts"), *by, F.col(latency).alias("latency_s"),
        refused.cast("double").alias("refused"),
    )
    return (
        rows.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window).alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.avg("latency_s").alias("mean_latency_s"),
            F.avg("refused").alias("refusal_rate"),
        )
        .select(F.col("w.start").alias("window_start"), *by, "requests", "mean_latency_s", "refusal_rate")
    )


def monitor_store(
    log: DataFrame, ts: str, latency: str, refused: Column, store: str, checkpoint: str, by: Sequence[str] = (),
    window: str = "1 day", lateness: str = "1 hour", every: str | None = None, sketch_size: int = distributions.SKETCH_SIZE,
) -> StreamingQuery:
    """Windows with a latency sketch each, kept current in ``store`` while they are open.

    The state of a window and group is a few sums and one sketch of bounded size. Each
    batch replaces the windows that it has changed (:mod:`gleanery.operators.store`), so a
    replayed batch counts nothing twice. Read them with :func:`stored_windows`.
    """
    rows = log.select(
        F.col(ts).cast("timestamp").alias("ts"), *by, F.col(latency).cast("double").alias("latency_s"), refused.cast("double").alias("refused")
    )
    windows = rows.withWatermark("ts", lateness).groupBy(F.window("ts", window).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("requests"), F.avg("latency_s").alias("mean_latency_s"), F.avg("refused").alias("refusal_rate"),
        distributions.sketch("latency_s", sketch_size).alias("latency_sketch"), F.max("ts").alias("newest"),
    )
    flat = windows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "requests", "mean_latency_s", "refusal_rate", "latency_sketch", "newest")

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed_rows = written(batch.withColumn("window_key", F.to_json(F.struct("window_start", *by), {"ignoreNullFields": "false"})), "windows")
        keys = keyed_rows.select("window_key", F.col("requests").alias("version"))
        keyed.merge_batch(batch.sparkSession, store, keys, keyed_rows, batch_id, "window_key", 8)

    writer = flat.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def stored_windows(spark: SparkSession, store: str, lateness: str = "1 hour", with_open: bool = True) -> DataFrame:
    """The windows of :func:`monitor_store` with ``is_open``, which rows may still change; on request without these."""
    rows = keyed.stored_rows(spark, store).drop("window_key")
    newest = rows.agg(F.max("newest")).head()[0]
    marked = rows.withColumn("is_open", F.col("window_end") + F.expr(f"INTERVAL {lateness}") > F.lit(newest)).drop("newest")
    return marked if with_open else marked.where("NOT is_open")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped in the batches whose progress Spark still keeps.

    That is the last ``spark.sql.streaming.numRecentProgressUpdates`` batches; ask a
    long-running stream before these have passed and add up.
    """
    return sum(
        op["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )


def drop_redelivered(
    stream: DataFrame, key: Sequence[str], ts: str = "ts", lateness: str = "1 hour"
) -> DataFrame:
    """One row per key among deliveries that lie within ``lateness``."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(key))
