from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators import chunking
from gleanery.streaming import jobs

PAGES = T.StructType([T.StructField("url", T.StringType()), T.StructField("content", T.StringType()), T.StructField("version", T.LongType())])


def to_chunks(pages):
    return chunking.finish_chunks(chunking.fixed_chunks(pages, keep=["url"], size=10, overlap=2), min_size=1)


def deliver(spark, folder, *rows):
    spark.createDataFrame(list(rows), PAGES).coalesce(1).write.mode("append").parquet(folder)


def sync(spark, tmp_path, checkpoint="check", **options):
    stream = jobs.read_file_stream(spark, f"{tmp_path}/in", PAGES, files_per_batch=1)
    query = jobs.sync_corpus(stream, to_chunks, f"{tmp_path}/store", f"{tmp_path}/{checkpoint}", newest_by="version", **options)
    query.awaitTermination()


def state(spark, store):
    return sorted((r.url, r.chunk_index, r.chunk_text) for r in jobs.current_chunks(spark, store).collect())


def batch(spark, *rows):
    df = to_chunks(spark.createDataFrame(list(rows), PAGES))
    return sorted((r.url, r.chunk_index, r.chunk_text) for r in df.collect())


def test_sync_replaces_pages_and_drops_what_they_lost(spark, tmp_path):
    a, b = ("a", "abcdefghijklmnopqrstuvwxyz", 1), ("b", "0123456789012345", 1)
    deliver(spark, f"{tmp_path}/in", a, b)
    sync(spark, tmp_path)
    assert state(spark, f"{tmp_path}/store") == batch(spark, a, b)
    # The page shrinks, comes twice in one batch, and another one becomes empty.
    deliver(spark, f"{tmp_path}/in", ("a", "old", 2), ("a", "short", 3), ("b", "", 3), ("c", "new page", 3))
    sync(spark, tmp_path)
    want = batch(spark, ("a", "short", 3), ("c", "new page", 3))
    assert state(spark, f"{tmp_path}/store") == want
    sync(spark, tmp_path)  # nothing new
    assert state(spark, f"{tmp_path}/store") == want
    jobs.compact(spark, f"{tmp_path}/store", f"{tmp_path}/base")
    assert state(spark, f"{tmp_path}/base") == want


def test_a_replayed_stream_gives_the_same_state(spark, tmp_path):
    rows = [("a", "abcdefghijklmnop", 1), ("b", "xyz", 1)]
    deliver(spark, f"{tmp_path}/in", *rows)
    sync(spark, tmp_path)
    first = state(spark, f"{tmp_path}/store")
    sync(spark, tmp_path, "fresh")  # the stream starts over and repeats batch 0
    assert state(spark, f"{tmp_path}/store") == first == batch(spark, *rows)


def test_continuous_sync_keeps_running(spark, tmp_path):
    deliver(spark, f"{tmp_path}/in", ("a", "abc", 1))
    stream = jobs.read_file_stream(spark, f"{tmp_path}/in", PAGES)
    query = jobs.sync_corpus(stream, to_chunks, f"{tmp_path}/store", f"{tmp_path}/check", every="1 second")
    try:
        query.processAllAvailable()
        deliver(spark, f"{tmp_path}/in", ("b", "def", 1))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert [u for u, *_ in state(spark, f"{tmp_path}/store")] == ["a", "b"]


LOG = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("s", T.DoubleType()), T.StructField("answer", T.StringType())])


def log(spark, folder, *rows):
    df = spark.createDataFrame([(i, t, s, a) for i, t, s, a in rows], "id long, ts string, s double, answer string")
    df.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(folder)


def test_windows_close_and_late_rows_are_counted(spark, tmp_path):
    folder = f"{tmp_path}/log"
    log(spark, folder, (1, "2024-01-01 01:00:00", 1.0, "no"), (2, "2024-01-01 02:00:00", 3.0, "yes"), (3, "2024-01-02 02:00:00", 5.0, "yes"))
    stream = jobs.read_file_stream(spark, folder, LOG)
    windows = jobs.monitor_windows(stream, "ts", "s", F.col("answer") == "no")

    def run():
        query = jobs.tail_log(windows, f"{tmp_path}/out", f"{tmp_path}/check")
        query.awaitTermination()
        return jobs.late_rows(query)

    assert run() == 0
    log(spark, folder, (4, "2024-01-01 03:00:00", 9.0, "no"), (5, "2024-01-02 03:00:00", 7.0, "no"))
    assert run() == 1
    log(spark, folder, (6, "2024-01-03 02:00:00", 7.0, "no"))
    run()
    rows = spark.read.parquet(f"{tmp_path}/out").orderBy("window_start").collect()
    assert [(str(r.window_start)[:10], r.requests, r.mean_latency_s, r.refusal_rate) for r in rows] == [
        ("2024-01-01", 2, 2.0, 0.5), ("2024-01-02", 2, 6.0, 0.5)
    ]


def test_redelivered_rows_are_kept_once(spark, tmp_path):
    folder = f"{tmp_path}/log"
    row = (1, "2024-01-01 01:00:00", 1.0, "a")
    log(spark, folder, row, row, (2, "2024-01-01 01:10:00", 1.0, "b"))
    once = jobs.drop_redelivered(jobs.read_file_stream(spark, folder, LOG), ["id"])
    for _ in range(2):
        jobs.tail_log(once, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
        log(spark, folder, row)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


def test_streams_read_tables_of_one_file_and_of_many(spark, sf_dir, tmp_path):
    from gleanery.plans import catalog_eval

    for name in ("pages", "events"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    for query in (catalog_eval.stream_corpus_sync, catalog_eval.stream_redelivered):
        assert sorted(query(spark, str(tmp_path)).collect()) == sorted(query(spark, sf_dir).collect())
