"""Exact top-k search by tiled matrix products.

Queries come in slices of bounded size, one after another; a slice is broadcast, every task multiplies its
own shard of the vectors with it, tile by tile, keeps the k best of each tile by
partial selection, and hands on one short list for each query. Lists are then merged in a
tree, so that no task ever holds more than ``FAN_IN`` lists of a query. A slice's lists are
written before the next slice comes, so one slice at a time is on the driver and in the
tasks, however many queries there are; the vectors are read where they lie, once a slice.

Components are integers, floor(1024 * x), and all sums are exact: products run in
double precision while every partial sum stays below 2 to the 53, and in Python's own
integers beyond.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import shared_dir, written

SCALE = 1024
TILE = 1024  # rows of either side in one product
SLICE_BYTES = 16 << 20
BOUND = 2.0**53  # components below it fit into a long when scaled
FAN_IN = 16
_LEAST = -(1 << 62)


def integral(vector: Column) -> Column:
    """floor(1024 * x) of each component, or null if one is null or non-finite. One beyond BOUND is an error."""
    x64 = lambda x: x.cast("double")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x64(x)) != float("inf")))
    beyond = F.raise_error(F.lit("a vector has a component of 2^53 or more, which does not fit into a long")).cast("bigint")
    scaled = F.transform(vector, lambda x: F.when(F.abs(x64(x)) < BOUND, F.floor(x64(x) * SCALE).cast("bigint")).otherwise(beyond))
    return F.when(vector.isNotNull() & finite, scaled)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), integral(F.col(vector_col)).alias("ints"))
    return rows.filter(F.col("id").isNotNull() & F.col("ints").isNotNull())


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and b."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if exact.size and max(abs(int(x)) for x in exact.ravel()) >= 1 << 62:
        raise OverflowError("an inner product does not fit into a long")
    return exact.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row, ties to the smaller id; by partial selection."""
    if scores.shape[1] > k:
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        keep = (scores >= kth).sum(axis=1).max()  # ties at the cut are still in
        part = np.argpartition(-scores, keep - 1, axis=1)[:, :keep] if keep < scores.shape[1] else np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
        scores, ids = np.take_along_axis(scores, part, axis=1), np.take_along_axis(ids, part, axis=1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Each query's k best rows: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    All rows of ``vectors`` but those of the query's own id are candidates. Rows whose
    id is null or whose vector is null or has a null or non-finite component take no
    part, as query or candidate. A finite component of 2^53 or more, and an inner product
    of 2^62 or more, is an error; no such row is left out. Vectors of another length than the query's score
    nothing with it. A query id that is repeated counts once, with its smallest vector;
    repeated candidates each have their place. Fewer than k candidates: all of them.
    Empty tables give no rows. Other columns are not looked at.
    """
    asked = usable(queries, id_col, vector_col).groupBy("id").agg(F.min("ints").alias("ints"))
    asked = written(asked.withColumn("length", F.size("ints")), "topk-queries")
    sizes = asked.groupBy("length").agg(F.count("*").alias("n")).collect()  # one row for each vector length
    rows, spark = usable(vectors, id_col, vector_col), vectors.sparkSession
    path = shared_dir(spark, "topk-lists")
    rows.limit(0).select(F.col("id").alias("query_id"), F.expr("cast(array() as array<struct<order:bigint,vec_id:bigint>>)").alias("best")).write.parquet(path)
    for length, n in sorted((r["length"], r["n"]) for r in sizes):
        parts = max(1, -(-n * max(1, length) * 8 // slice_bytes))
        for part in range(parts):
            chosen = asked.filter((F.col("length") == length) & (F.pmod(F.xxhash64("id"), F.lit(parts)) == part)).select("id", "ints")
            got = chosen.toArrow()  # at most about slice_bytes
            ids = got.column("id").to_numpy()
            flat = got.column("ints").combine_chunks()
            matrix = np.asarray(flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays(flat.chunks).flatten()).reshape(len(ids), length)
            shared = spark.sparkContext.broadcast((ids, matrix))
            _merged(_partial(rows, shared, k), k).write.mode("append").parquet(path)
            shared.unpersist()
    out = spark.read.schema("query_id bigint, best array<struct<order:bigint,vec_id:bigint>>").parquet(path).select("query_id", F.posexplode("best").alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.order")).alias("score"))


def _partial(rows: DataFrame, shared: Broadcast, k: int) -> DataFrame:
    """One list for each query of the slice and task that has candidates for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        q_ids, q = shared.value
        scores = np.full((len(q_ids), 0), 0, np.int64)
        hits = np.full((len(q_ids), 0), 0, np.int64)
        for b in batches:
            column = b.column("ints")
            fit = np.asarray(column.value_lengths()) == q.shape[1]
            if not fit.any():
                continue
            column = column.filter(pa.array(fit))
            c_ids = np.asarray(b.column("id"))[fit]
            c = np.asarray(column.flatten()).reshape(len(c_ids), q.shape[1])
            for at in range(0, len(c_ids), TILE):
                tile, tile_ids = c[at : at + TILE], c_ids[at : at + TILE]
                new_s, new_h = [], []
                for lo in range(0, len(q_ids), TILE):
                    s = product(q[lo : lo + TILE], tile)
                    s[q_ids[lo : lo + TILE, None] == tile_ids[None, :]] = _LEAST  # not with itself
                    t = best(s, np.broadcast_to(tile_ids, s.shape), k)
                    new_s.append(t[0])
                    new_h.append(t[1])
                scores, hits = best(np.hstack([scores, np.vstack(new_s)]), np.hstack([hits, np.vstack(new_h)]), k)
        if scores.shape[1]:
            lists = [[{"order": -int(s), "vec_id": int(h)} for s, h in zip(a, b, strict=True) if s > _LEAST] for a, b in zip(scores, hits, strict=True)]
            kind = pa.list_(pa.struct([("order", pa.int64()), ("vec_id", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(q_ids), pa.array(lists, kind), pa.array(np.full(len(q_ids), TaskContext.get().partitionId(), np.int32))], names=["query_id", "best", "task"])

    return rows.mapInArrow(run, "query_id bigint, best array<struct<order:bigint,vec_id:bigint>>, task int")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """Merge the tasks' lists in a tree; each level joins FAN_IN neighbours."""
    tasks = lists.rdd.getNumPartitions()
    merge = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")
    while tasks > 1:
        lists = lists.groupBy("query_id", F.floor(F.col("task") / FAN_IN).cast("int").alias("task")).agg(merge)
        tasks = -(-tasks // FAN_IN)
    return lists.select("query_id", "best")
