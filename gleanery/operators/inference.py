"""Batch calls of a caller-supplied function, and what is built on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from hashlib import md5
import threading
import time
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleanery.operators.keyword_search import words
from gleanery.operators.store import _exists
from gleanery.session import shared_dir, written_counted

# Texts per call, attempts, and the bounds of the wait in seconds.
BATCH_SIZE = 150
ATTEMPTS = 4
WAIT_MIN, WAIT_MAX = 1.0, 10.0
PAGE_ROWS = 100  # rows of a page, the least that a portion reads of a file of new texts


class RetryBudget:
    """So many repeated calls in all, shared by the threads of a task; None is without end."""

    def __init__(self, calls: int | None):
        self.left, self.lock = calls, threading.Lock()

    def take(self) -> bool:
        with self.lock:
            if self.left is None:
                return True
            self.left -= 1
            return self.left >= 0


def call_with_retry(fn: Callable, *args, attempts: int = ATTEMPTS, wait_min: float = WAIT_MIN,
                    wait_max: float = WAIT_MAX, sleep: Callable[[float], None] = time.sleep,
                    budget: RetryBudget | None = None):
    """Call again after a failure, waiting twice as long each time, while the budget lasts."""
    for attempt in range(attempts):
        try:
            return fn(*args)
        except Exception:
            if attempt + 1 == attempts or budget and not budget.take():
                raise
            sleep(min(max(wait_min * 2**attempt, wait_min), wait_max))


def map_in_batches(
    df: DataFrame,
    fn: Callable[..., Sequence],
    inputs: Sequence[str],
    output: str,
    kind: T.DataType,
    batch_size: int = BATCH_SIZE,
    attempts: int = ATTEMPTS,
    wait_min: float = WAIT_MIN,
    wait_max: float = WAIT_MAX,
    latency: str | None = None,
    check: Callable[[object], None] | None = None,
    in_flight: int = 1,
    max_retries: int | None = None,
) -> DataFrame:
    """Add ``output`` and ``error``: ``fn`` gets one list per input, row order kept.

    A call that still fails after the last attempt is halved, and so on down to
    single rows: only rows that fail by themselves get an error text and a null
    output, and the job goes on. ``latency`` names a column for the seconds that
    the row's call took; with ``batch_size=1`` that is its own latency. A row
    that failed has none. ``in_flight`` calls of a task run side by side, for models that
    wait for a server; rows keep their order, and no more than one Arrow batch is held.
    ``max_retries`` bounds the repeated calls of a task.
    """
    if in_flight < 1:
        raise ValueError("in_flight must be at least 1")
    fields = [T.StructField(output, kind), T.StructField("error", T.StringType())]
    if latency:
        fields.append(T.StructField(latency, T.DoubleType()))
    schema = T.StructType([*df.schema.fields, *fields])
    arrow_kind = to_arrow_type(kind)

    def outcome(part: pa.RecordBatch, tries: int, budget: RetryBudget) -> Iterator[tuple[pa.Array, str | None, float]]:
        """Column, error and seconds of each call that it took to get through ``part``."""
        args = [part.column(part.schema.get_field_index(c)).to_pylist() for c in inputs]
        began = time.perf_counter()
        try:
            values = list(call_with_retry(
                fn, *args, attempts=tries, wait_min=wait_min, wait_max=wait_max, budget=budget))
            if len(values) != part.num_rows:
                raise ValueError(f"{part.num_rows} inputs gave {len(values)} outputs")
            if check:
                for v in values:
                    check(v)
            yield pa.array(values, arrow_kind), None, time.perf_counter() - began
        except Exception as e:  # noqa: BLE001 - reported in the error column
            if part.num_rows == 1:
                yield pa.nulls(1, arrow_kind), f"{type(e).__name__}: {e}", time.perf_counter() - began
                return
            half = part.num_rows // 2
            for piece in (part.slice(0, half), part.slice(half)):
                # whether the fault was passing has been tried; single rows get all attempts again
                yield from outcome(piece, attempts if piece.num_rows == 1 else 1, budget)

    def done(part: pa.RecordBatch, budget: RetryBudget) -> pa.RecordBatch:
        columns, errors, seconds = [], [], []
        for column, error, took in outcome(part, attempts, budget):
            columns.append(column)
            errors += [error] * len(column)
            seconds += [None if error else took] * len(column)
        extra = [pa.concat_arrays(columns), pa.array(errors, pa.string())]
        if latency:
            extra.append(pa.array(seconds, pa.float64()))
        return pa.RecordBatch.from_arrays([*part.columns, *extra], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        budget = RetryBudget(max_retries)
        if in_flight == 1:
            for whole in batches:
                for at in range(0, whole.num_rows, batch_size):
                    yield done(whole.slice(at, batch_size), budget)
            return
        with ThreadPoolExecutor(in_flight) as pool:
            for whole in batches:
                parts = [whole.slice(at, batch_size) for at in range(0, whole.num_rows, batch_size)]
                yield from pool.map(lambda part: done(part, budget), parts)

    return df.mapInArrow(run, schema)


def embed_texts(
    df: DataFrame, text: str, embed_fn: Callable[[list[str]], Sequence[Sequence[float]]],
    dimension: int, output: str = "vector", **options,
) -> DataFrame:
    """Add the vector of each text. Use one ``embed_fn`` for corpus and queries.

    A vector of another dimension than the declared one is an error of its batch.
    """

    def check(vector) -> None:
        if len(vector) != dimension:
            raise ValueError(f"expected dimension {dimension}, got {len(vector)}")

    return map_in_batches(
        df, embed_fn, [text], output, T.ArrayType(T.FloatType()), check=check, **options
    )


def _portion(column: str, i: int, portions: int) -> Column:
    """The ``i``-th of equal ranges of a hash in hex digits; such hashes are spread evenly."""
    bounds = [f"{(at << 32) // portions:08x}" for at in (i, i + 1)]
    after = F.col(column) >= bounds[0]
    return after if i + 1 == portions else after & (F.col(column) < bounds[1])


def embed_changed(
    df: DataFrame, text: str, embed_fn: Callable[[list[str]], Sequence[Sequence[float]]], dimension: int, store: str,
    model: str, output: str = "vector", portion_rows: int = 100_000, **options,
) -> DataFrame:
    """Add the vector of each text, calling the model only for texts that ``store`` does not know.

    The store is a table of vectors by content hash and name of the model. Texts that are
    new to it are called once each, however many rows have them, in portions of about
    ``portion_rows`` that are appended one by one: a job that is started again calls for
    none that are stored. Vectors that fail are not stored and have an ``error`` here. A
    null text has neither. One job at a time may write to a store.

    A portion is a range of hashes, and new texts lie in their files in the order of these, so
    that a portion reads its own pages of each file and not all new texts.
    """
    spark = df.sparkSession
    path = f"{store}/model={quote(model, safe='')}"
    rows = df.withColumn("_hash", F.sha2(F.col(text), 256))
    schema = f"content_hash string, {output} array<float>"

    def stored() -> DataFrame:
        return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)

    wanted = rows.where("_hash IS NOT NULL").groupBy(F.col("_hash").alias("content_hash")).agg(F.any_value(text).alias("_text"))
    unknown = wanted.join(stored().select("content_hash"), "content_hash", "left_anti").sortWithinPartitions("content_hash")
    new, n = written_counted(unknown, "embed-new", **{"parquet.page.row.count.limit": PAGE_ROWS})
    portions, called = -(-n // portion_rows), shared_dir(spark, "embed-made")
    for i in range(portions):
        part = new.where(_portion("content_hash", i, portions))
        embed_texts(part, "_text", embed_fn, dimension, output, **options).drop("_text").write.parquet(f"{called}/portion={i}")
        made = spark.read.parquet(f"{called}/portion={i}")
        made.where("error IS NULL").select("content_hash", output).write.mode("append").parquet(path)
    failed = "content_hash string, error string"
    errors = spark.read.schema(failed).parquet(called).drop("portion") if portions else spark.createDataFrame([], failed)
    errors = errors.where("error IS NOT NULL")
    known = stored().dropDuplicates(["content_hash"]).withColumnRenamed("content_hash", "_known")  # a portion may be there twice
    out = rows.join(known, F.col("_hash") == F.col("_known"), "left")
    return out.join(errors.withColumnRenamed("content_hash", "_failed"), F.col("_hash") == F.col("_failed"), "left").drop("_hash", "_known", "_failed")


class HashingEmbedder:
    """Signed counts of hashed words: deterministic, no model. For tests and baselines.

    Vectors are not scaled to unit length; cosine search does that.
    """

    def __init__(self, dimension: int = 64):
        self.dimension = dimension

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        place = lru_cache(maxsize=200_000)(self._place)
        out = np.zeros((len(texts), self.dimension), np.float32)
        for row, text in enumerate(texts):
            for word in words(text):
                bucket, sign = place(word)
                out[row, bucket] += sign
        return list(out)

    def _place(self, word: str) -> tuple[int, int]:
        digest = md5(word.encode()).hexdigest()
        return int(digest[:8], 16) % self.dimension, 1 if digest[8] < "8" else -1


def extractive_answers(refusal: str) -> Callable[[list[str], list[str]], list[str]]:
    """A stand-in for a model: the first context block, or the refusal sentence."""

    def generate(system: list[str], human: list[str]) -> list[str]:
        out = []
        for text in human:
            _, _, rest = text.partition("\n[1] Source: ")
            _, _, body = rest.partition("\n")
            out.append(body.split("\n\n")[0].strip() or refusal)
        return out

    return generate


def answer_prompts(
    prompted: DataFrame, generate_fn: Callable[[list[str], list[str]], list[str]], **options
) -> DataFrame:
    """Add ``answer``, ``latency_s`` and ``error`` to a table of prompts.

    A prompt is a call of its own unless ``batch_size`` says otherwise, so that
    latency is per question.
    """
    options.setdefault("batch_size", 1)
    return map_in_batches(
        prompted, generate_fn, ["system", "human"], "answer", T.StringType(),
        latency="latency_s", **options,
    )


def judge_answers(
    answers: DataFrame, judge_fn: Callable[..., list[dict]], inputs: Sequence[str],
    metrics: Sequence[str], **options,
) -> DataFrame:
    """Add one double column per metric from a judge of your own."""
    kind = T.StructType([T.StructField(m, T.DoubleType()) for m in metrics])
    judged = map_in_batches(answers, judge_fn, inputs, "_judged", kind, **options)
    return judged.select("*", *[F.col(f"_judged.{m}").alias(m) for m in metrics]).drop("_judged")
