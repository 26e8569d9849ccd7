"""Checked queries: latency, judges, the gate, monitoring and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import chunking, distributions, evaluate, markup, monitor, quantiles
from gleanery.operators import store as keyed
from gleanery.plans.catalog_text import load, long
from gleanery.session import shared_dir, written
from gleanery.sources import tables
from gleanery.streaming import jobs


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a request log: value = latency, error = refusal, props = answer."""
    return load(spark, sf, "events")


def _refused():
    return F.col("event_type") == "error"


def _rounded(df: DataFrame, *names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def latency_stats(spark, sf):
    s = evaluate.latency_stats(_log(spark, sf), "value")
    return s.select(*_rounded(s, *s.columns))


def latency_stats_ranked(spark, sf):
    """The way for groups that are too large for one task."""
    rows = _log(spark, sf).select("event_type", F.col("value").alias("_v"))
    q = quantiles.ranked_quantiles(rows, {"p50_seconds": 0.5, "p90_seconds": 0.9}, ["event_type"], 32)
    return q.select("event_type", *_rounded(q, "p50_seconds", "p90_seconds"))


ROLLUP = ("mean_latency_s", "mean_answer_length", "refusal_rate", "p50_latency_s", "p90_latency_s")


def _rollup(spark, sf) -> DataFrame:
    return monitor.daily_rollup(_log(spark, sf), "ts", "value", F.length("props"), _refused())


def daily_monitor(spark, sf):
    r = _rollup(spark, sf)
    return r.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "requests", *_rounded(r, *ROLLUP))


def daily_drift(spark, sf):
    d = monitor.drift(_rollup(spark, sf), ["mean_latency_s", "refusal_rate"])
    names = [c for c in d.columns if c.endswith(("_change", "_ratio"))]
    return d.select(F.date_format("day", "yyyy-MM-dd").alias("day"), *_rounded(d, *names))


def newest_log_rows(spark, sf):
    return tables.newest_rows(_log(spark, sf), 5, "ts", "event_id").select("event_id", "event_type", "value")


def judge_means(spark, sf):
    judged = load(spark, sf, "labels").select(
        F.col("quality").cast("double").alias("correctness"), (1.0 - F.col("toxic")).alias("safety")
    )
    m = evaluate.judge_means(judged, ["correctness", "safety"])
    return m.select(*_rounded(m, *m.columns))


def _source_metrics(spark, sf) -> DataFrame:
    """Metrics per source of the judged documents; a long text stands for a slow answer."""
    judged = load(spark, sf, "labels").join(load(spark, sf, "documents"), "doc_id").select(
        "source", "quality", "toxic", (F.col("n_chars") / 1000.0).alias("seconds")
    )
    means = judged.groupBy("source").agg(
        F.avg(1.0 - F.col("toxic")).alias("groundedness_mean"),
        F.avg("quality").alias("correctness_mean"),
    )
    q = quantiles.exact_quantiles(judged, "seconds", {"p50_seconds": 0.5, "p90_seconds": 0.9}, ["source"])
    return means.join(q, "source", "left")


def quality_gate(spark, sf):
    gated = evaluate.quality_gate(_source_metrics(spark, sf))
    return gated.select(
        "source", *_rounded(gated, "groundedness_mean", "correctness_mean", "p90_seconds"),
        long("passed").alias("passed"), F.array_join("failed_checks", "; ").alias("failed_checks"),
    )


def diagnosis(spark, sf):
    """Each team's metrics: for each kind of event, a metric that such an event lowers."""
    kinds = {"correctness": "error", "precision": "view", "recall": "click", "groundedness": "purchase", "relevance": "signup"}
    rows = _log(spark, sf).withColumn("team", F.pmod("user_id", F.lit(40)))
    m = rows.groupBy("team").agg(*[F.avg((F.col("event_type") != kind).cast("int")).alias(name) for name, kind in kinds.items()])
    q = quantiles.exact_quantiles(rows, "value", {"p50": 0.5, "p90": 0.9}, ["team"])
    found = evaluate.diagnosis("precision", "recall", "groundedness", "relevance", "correctness", "p50", "p90", low=0.79, high=0.81)
    return m.join(q, "team", "left").select("team", found.alias("diagnosis"))


def lexical_judges(spark, sf):
    """Each assistant turn is judged against the turn before it."""
    turns = load(spark, sf, "conversations")
    answers = turns.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer"))
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("context"))
    judged = evaluate.lexical_judgements(
        answers.join(before, ["conv_id", "turn"], "left"), expected="context"
    )
    names = ("lexical_groundedness", "lexical_correctness")
    return judged.select("conv_id", "turn", *_rounded(judged, *names))


# --- streams ------------------------------------------------------------------


def _stream_session(spark: SparkSession) -> SparkSession:
    """Own settings: state is split once for all, by the slots there are."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return own


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table that is one file or a folder of files."""
    return jobs.read_file_stream(spark, f"{sf}/{name}.parquet", load(spark, sf, name).schema)


def _drain(stream: DataFrame, sink: str, checkpoint: str) -> None:
    jobs.tail_log(stream, sink, checkpoint).awaitTermination()


def stream_corpus_sync(spark, sf):
    own = _stream_session(spark)
    store, checkpoint = shared_dir(spark, "store"), shared_dir(spark, "sync")

    def to_chunks(pages: DataFrame) -> DataFrame:
        texts = markup.html_to_markdown(pages.select("url", "html"))
        return chunking.finish_chunks(chunking.fixed_chunks(texts, keep=["url"]))

    jobs.sync_corpus(
        _stream(own, sf, "pages"), to_chunks, store, checkpoint, newest_by="page_id"
    ).awaitTermination()
    return jobs.current_chunks(spark, store).select(
        "chunk_id", "url", long("chunk_index").alias("chunk_index"), F.md5("chunk_text").alias("text_md5")
    )


def _batches(pages: DataFrame) -> list[DataFrame]:
    """Pages as they come in: all of them, then new versions and removals, then late and repeated ones."""
    every, third, seventh, fifth = (F.pmod("page_id", F.lit(n)) == 0 for n in (1, 3, 7, 5))
    page = lambda at, note, version, removed=F.lit(False): pages.where(at).select(
        F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("url"), "html", F.lit(note).alias("note"),
        F.lit(version).cast("bigint").alias("version"), removed.alias("removed"),
    )
    return [
        page(every, "first", 1), page(third | seventh, "second", 2, seventh),
        page(third | seventh, "late", 1).unionByName(page(fifth & ~third & ~seventh, "again", 1)).unionByName(page(fifth & ~third & ~seventh, "older", 0)),
    ]


def stream_store_buckets(spark, sf):
    """Three batches with updates, removals, late and repeated pages, and one of them once more."""
    own = _stream_session(spark)
    source, store, checkpoint = (shared_dir(spark, n) for n in ("incoming", "store", "sync"))

    def to_chunks(pages: DataFrame) -> DataFrame:
        texts = markup.html_to_markdown(pages.select("url", "html", "note"))
        texts = texts.select("url", F.concat_ws(" ", "note", "content").alias("content"))
        return chunking.finish_chunks(chunking.fixed_chunks(texts, keep=["url"]))

    batches = _batches(load(spark, sf, "pages"))
    for batch in batches:
        batch.write.mode("append").parquet(source)
        stream = jobs.read_file_stream(own, source, batch.schema)
        jobs.sync_store(stream, to_chunks, store, checkpoint, newest_by="version", removed="removed", buckets=8).awaitTermination()
    keyed.merge_batch(spark, store, batches[1].select("url", "version"), to_chunks(batches[1]), 1, buckets=8)  # replayed
    return keyed.stored_rows(spark, store).select(
        "chunk_id", "url", long("chunk_index").alias("chunk_index"), F.md5("chunk_text").alias("text_md5")
    )


def stream_log_tail(spark, sf):
    own, sink = _stream_session(spark), shared_dir(spark, "log")
    _drain(_stream(own, sf, "events"), sink, shared_dir(spark, "tail"))
    return tables.newest_rows(spark.read.parquet(sink), 5, "ts", "event_id").select("event_id", "value")


def stream_monitor(spark, sf):
    own, sink = _stream_session(spark), shared_dir(spark, "windows")
    windows = jobs.monitor_windows(_stream(own, sf, "events"), "ts", "value", _refused(), ["event_type"])
    shown = windows.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "requests",
        "mean_latency_s", "refusal_rate",
    )
    _drain(shown, sink, shared_dir(spark, "monitor"))
    done = spark.read.parquet(sink)
    return done.select("day", "event_type", "requests", *_rounded(done, "mean_latency_s", "refusal_rate"))


def stream_quantiles(spark, sf):
    """Windows with sketches, the open one too: do p50 and p90 of each, and of all of them merged, lie within the error?"""
    own, store = _stream_session(spark), shared_dir(spark, "sketches")
    jobs.monitor_store(_stream(own, sf, "events"), "ts", "value", _refused(), store, shared_dir(spark, "sketching"), ["event_type"]).awaitTermination()
    windows = jobs.stored_windows(spark, store).withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    asked = {"p50": 0.5, "p90": 0.9}
    days = distributions.merged_quantiles(windows, "latency_sketch", asked, ["day", "event_type"])
    every = distributions.merged_quantiles(windows, "latency_sketch", asked, ["event_type"]).withColumn("day", F.lit("all"))
    found = written(days.unionByName(every), "quantiles")
    events = _log(spark, sf).select(F.explode(F.array(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd"), F.lit("all"))).alias("day"), "event_type", "value")
    error = distributions.rank_error()

    def within(name: str):  # the range of ranks that equal values share must meet the allowed one
        low, high = F.count(F.when(F.col("value") < F.col(name), 1)) / F.count("*"), F.count(F.when(F.col("value") <= F.col(name), 1)) / F.count("*")
        return ((low <= asked[name] + error) & (high >= asked[name] - error)).alias(f"{name}_within")

    checked = events.join(found, ["day", "event_type"]).groupBy("day", "event_type").agg(F.count("*").alias("requests"), within("p50"), within("p90"))
    opened = windows.select("day", "event_type", "is_open")
    return checked.join(opened, ["day", "event_type"], "left").select("day", "event_type", "requests", "p50_within", "p90_within", F.coalesce("is_open", F.lit(False)).alias("is_open"))


def _shifted(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Events before the 15th as baseline, the others by day; those of the 20th are twice as slow."""
    rows = _log(spark, sf).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    late = rows.where("day >= '2024-01-15'").withColumn("value", F.when(F.col("day") == "2024-01-20", 2 * F.col("value")).otherwise(F.col("value")))
    return rows.where("day < '2024-01-15'"), late


def distribution_drift(spark, sf):
    baseline, current = _shifted(spark, sf)
    psi = distributions.stability_index(baseline, current, "value", "day")
    ks = distributions.ks_statistic(baseline, current, "value", "day").drop("n")
    both = psi.join(ks, "day")
    return both.select("day", "n", *_rounded(both, "psi", "ks"), (F.col("psi") > 0.2).alias("shifted"))


def stratified_sample(spark, sf):
    """Fifty slow-weighted requests of each kind, two hundred errors."""
    taken = distributions.stratified_sample(_log(spark, sf), "event_id", "event_type", {"error": 200}, 1.0 + F.col("value"), default=50)
    return taken.select("event_id", "event_type")


def stream_redelivered(spark, sf):
    """Every event is delivered twice and kept once."""
    own, sink = _stream_session(spark), shared_dir(spark, "once")
    twice = _stream(own, sf, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"),
    )
    _drain(jobs.drop_redelivered(twice, ["event_id"]).drop("delivery"), sink, shared_dir(spark, "dedup"))
    return spark.read.parquet(sink).select("event_id", "event_type")


QUERIES = {
    f.__name__: f
    for f in (
        latency_stats, latency_stats_ranked, daily_monitor, daily_drift, newest_log_rows,
        judge_means, quality_gate, diagnosis, lexical_judges,
        distribution_drift, stratified_sample, stream_corpus_sync, stream_store_buckets, stream_quantiles, stream_log_tail, stream_monitor, stream_redelivered,
    )
}
