"""A kept inverted index for BM25: compressed postings, and blocks passed over by their best score.

Documents are numbered in the order of their ids. A task goes through its documents and
closes a slice after SLICE_DOCS of them or SLICE_WORDS words; a term's postings of a slice
are cut into blocks of BLOCK postings, each stored as one row with its numbers delta-coded
and the highest share of a score that any of its postings gives. A common term is thus many
rows in many tasks. Postings lie in buckets by the hash of their term, in order of terms.

A search goes through the postings once, for the blocks of its terms. A term's k-th
best block bounds the k-th score from below; a block whose best share, with the best the
other terms give in that slice, stays under that bound is not scored. The text of a
document is never read.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions import text as X
from gleanery.operators import topk as engine
from gleanery.operators.keyword_search import B, K1, words
from gleanery.session import written

BLOCK = 128
SLICE_DOCS, SLICE_WORDS = 1 << 14, 1 << 20
BUCKETS = 64
SENT_ROWS = 1 << 15  # blocks in a batch that leaves a task
SLACK = 2.0 * 10.0**-engine.DECIMALS  # rounded scores tie


def _packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers as bytes of seven bits, lowest first; the high bit says that more follow. And where each one ends."""
    left = values.astype(np.uint64)
    size = np.maximum(1, -(-np.ceil(np.log2(left.astype(np.float64) + 1)).astype(np.int64) // 7))
    size += (size < 10) & (left >> np.minimum(7 * size, 63).astype(np.uint64) > 0)  # where the logarithm was rounded
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(int(size.max(initial=0))):
        has = size > i
        more = (size[has] > i + 1).astype(np.uint8) << 7
        out[(ends - size)[has] + i] = ((left[has] >> np.uint64(7 * i)) & np.uint64(0x7F)).astype(np.uint8) | more
    return out, ends


def packed(values: np.ndarray) -> bytes:
    return _packed(values)[0].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 0x80)
    if not len(ends):
        return np.zeros(0, np.int64)
    begins = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(begins, ends - begins + 1)
    return np.add.reduceat((raw & 0x7F).astype(np.int64) << (7 * place), begins)


def share(tf, length, mean_length: float, k1: float, b: float):
    """What a posting gives to a score, but for the weight of its term."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean_length))


POSTINGS = "term string, slice bigint, block int, first bigint, n int, best double, data binary"


def _blocks_of(
    terms: list[str], at: Sequence[int], numbers: Sequence[int], counts: Sequence[int], lengths: Sequence[int], mean_length: float, k1: float, b: float,
) -> Iterator[pa.RecordBatch]:
    """The postings of one slice; ``at`` is the number of the term, documents come in order.

    All blocks are packed at once and cut apart by their bounds: most terms of a slice
    have few postings, and a call for each would cost more than its numbers.
    """
    term, number, tf, length = (np.array(x, np.int64) for x in (at, numbers, counts, lengths))
    slice_of = number[0]
    order = np.argsort(term, kind="stable")
    term, number, tf, length = term[order], number[order], tf[order], length[order]
    opens = np.concatenate([[True], term[1:] != term[:-1]])
    inside = np.arange(len(term)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]
    starts = np.flatnonzero(inside % BLOCK == 0)
    n = np.diff(starts, append=len(term))
    begin, width = np.repeat(starts, n), np.repeat(n, n)
    place = 2 * begin + np.arange(len(term))  # a block's steps, then its counts, then its lengths
    values = np.empty(3 * len(term), np.int64)
    values[place] = np.where(np.arange(len(term)) == begin, 0, np.diff(number, prepend=0))
    values[place + width] = tf
    values[place + 2 * width] = length
    data, ends = _packed(values)
    offsets = np.concatenate([[0], ends[3 * (starts + n) - 1]]).astype(np.int32)
    blocks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    best = np.maximum.reduceat(share(tf, length, mean_length, k1, b), starts)
    columns = [
        pa.array(terms, pa.string()).take(pa.array(term[starts])), pa.array(np.full(len(starts), slice_of)), pa.array((inside[starts] // BLOCK).astype(np.int32)),
        pa.array(number[starts]), pa.array(n.astype(np.int32)), pa.array(best), blocks,
    ]
    rows = pa.RecordBatch.from_arrays(columns, names=["term", "slice", "block", "first", "n", "best", "data"])
    for i in range(0, len(starts), SENT_ROWS):
        yield rows.slice(i, SENT_ROWS)


def build_text_index(documents: DataFrame, path: str, key: str = "chunk_id", text: str = "chunk_text", k1: float = K1, b: float = B) -> None:
    """Write the index of all documents below ``path``.

    Keys must be unique; rows with a null key or text are left out, empty texts count as
    documents. Texts are shuffled once, into the order of their keys, and read again once:
    their lengths are written beside them.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    # rising with the id, as ranges and rows in them do
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id").withColumn("number", F.monotonically_increasing_id())
    numbered = written(ordered.withColumn("length", F.size(X.tokens("text"))), "text-index-numbered")
    total = numbered.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).head()
    mean_length = float(total["mean"] or 0.0) or 1.0
    spark.createDataFrame([(total["n"], mean_length, k1, b)], "n bigint, mean_length double, k1 double, b double").coalesce(1).write.mode("overwrite").parquet(f"{path}/totals")
    numbered.select("number", "id").write.mode("overwrite").parquet(f"{path}/documents")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[str, int] = {}
        columns = tuple(array("q") for _ in range(4))
        docs, held, last = 0, 0, -1

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal docs, held
            if columns[0]:
                yield from _blocks_of(list(place), *columns, mean_length, k1, b)
            place.clear()
            for c in columns:
                del c[:]
            docs = held = 0

        for batch in batches:
            for number, doc in zip(batch.column("number").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if number < last or docs >= SLICE_DOCS or held >= SLICE_WORDS:  # files may come in any order
                    yield from closed()
                found = words(doc)
                counts = Counter(found)
                columns[0].extend([place.setdefault(w, len(place)) for w in counts])
                columns[1].extend([number] * len(counts))
                columns[2].extend(counts.values())
                columns[3].extend([len(found)] * len(counts))
                docs, held, last = docs + 1, held + len(counts), number
        yield from closed()

    postings = numbered.select("number", "text").mapInArrow(run, POSTINGS)
    in_buckets = postings.withColumn("bucket", _bucket()).hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "slice")
    in_buckets.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")


def _bucket():
    return F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int")


def _chosen(asked: DataFrame, postings: DataFrame, n: int, k: int) -> DataFrame:
    """The blocks that can hold one of the k best, with ``query_id, idf`` of each query that asks for their term.

    The postings are read once: all later steps read the blocks of the asked terms.
    """
    terms = asked.select("term").distinct()
    columns = [c for c in postings.columns if c != "bucket"]
    known = written(postings.select(columns).join(terms, "term", "left_semi"), "text-index-known")
    slices = written(known.groupBy("term", "slice").agg(F.max("best").alias("most"), F.sum("n").alias("docs")), "text-index-slices")
    by_best = Window.partitionBy("term").orderBy(F.col("best").desc())
    kth = known.select("term", "best", F.row_number().over(by_best).alias("place")).where(F.col("place") <= k)
    kth = kth.groupBy("term").agg(F.max(F.when(F.col("place") == k, F.col("best"))).alias("kth"))
    df = slices.groupBy("term").agg(F.sum("docs").alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = asked.join(df, "term").join(kth, "term").select("query_id", "term", idf.alias("idf"), "kth")
    least = F.coalesce(F.max(F.col("idf") * F.col("kth")).over(Window.partitionBy("query_id")), F.lit(0.0)) - SLACK
    weighted = written(weighted.select("query_id", "term", "idf", least.alias("least")), "text-index-terms")
    top = F.sum(F.col("idf") * F.col("most")).over(Window.partitionBy("query_id", "slice"))
    live = slices.select("term", "slice", "most").join(weighted, "term").withColumn("top", top).where("top >= least")
    blocks = known.join(live, ["term", "slice"])
    blocks = blocks.where(F.col("top") - F.col("idf") * (F.col("most") - F.col("best")) >= F.col("least"))
    return blocks.select("query_id", "idf", *columns)


def _asked(spark: SparkSession, path: str, queries: DataFrame, query_id: str, query_text: str) -> tuple[DataFrame, DataFrame]:
    """Query terms, and the postings in the buckets of these."""
    asked = queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(X.tokens(query_text))).alias("term"))
    asked = written(asked.where("query_id IS NOT NULL"), "text-index-asked")
    buckets = [r[0] for r in asked.select(_bucket().alias("b")).distinct().collect()]  # at most BUCKETS
    postings = spark.read.schema(f"{POSTINGS}, bucket int").parquet(f"{path}/postings")
    return asked, postings.where(F.col("bucket").isin(buckets)) if buckets else postings.limit(0)


def search_text_index(queries: DataFrame, path: str, k: int, query_id: str = "query_id", query_text: str = "text") -> DataFrame:
    """The k best documents of every query by BM25: ``query_id, item_id, score, rank``.

    The same hits as :func:`gleanery.operators.keyword_search.bm25_search`, from the
    index alone. Null query texts have no words and no hits. A task scores one query in
    one slice at a time; a slice sends k rows at most.
    """
    spark = queries.sparkSession
    total = spark.read.parquet(f"{path}/totals").head()
    asked, postings = _asked(spark, path, queries, query_id, query_text)
    chosen = _chosen(asked, postings, total["n"], k)
    mean_length, k1, b = total["mean_length"], total["k1"], total["b"]

    def best(table: pa.Table) -> pa.Table:
        idf, first, n = (table.column(c).to_numpy() for c in ("idf", "first", "n"))
        values = unpacked(b"".join(table.column("data").to_pylist()))  # all blocks at once, as most are short
        begin, width = np.repeat(np.cumsum(n) - n, n), np.repeat(n, n)
        place = 2 * begin + np.arange(len(begin))
        steps, tf, length = values[place], values[place + width], values[place + 2 * width]
        upto = np.cumsum(steps)
        numbers = np.repeat(first, n) + upto - upto[begin]  # a block's first step is 0
        scores = np.repeat(idf, n) * share(tf, length, mean_length, k1, b)
        number, at = np.unique(numbers, return_inverse=True)
        score = np.round(np.bincount(at, scores), engine.DECIMALS)
        top = np.lexsort((number, -score))[:k]
        return pa.table({"query_id": table.column("query_id").take(pa.array(np.zeros(len(top), np.int64))), "number": number[top], "score": score[top]})

    kind = asked.schema["query_id"].dataType.simpleString()
    held = chosen.select("query_id", "slice", "idf", "first", F.col("n").cast("long").alias("n"), "data", "term")
    scored = held.groupBy("query_id", "slice").applyInArrow(lambda t: best(t.sort_by("term")), f"query_id {kind}, number bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "number")
    hits = written(scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "text-index-hits")
    ids = spark.read.parquet(f"{path}/documents")
    return ids.join(hits, "number").select("query_id", F.col("id").alias("item_id"), "score", "rank")


def read_share(queries: DataFrame, path: str, k: int, query_id: str = "query_id", query_text: str = "text") -> float:
    """The share of the postings blocks of all query terms that a search scores."""
    spark = queries.sparkSession
    asked, postings = _asked(spark, path, queries, query_id, query_text)
    n = spark.read.parquet(f"{path}/totals").head()["n"]
    every = asked.join(postings.select("term", "slice", "block"), "term").count()
    return _chosen(asked, postings, n, k).count() / max(1, every)
