"""Top-k matches of many queries against a corpus, without emitting all pairs.

Three ways give the same rows:

* few queries (their number and bytes are checked): every task scores its own
  part of the corpus against all of them and keeps k per query;
* a small corpus (checked alike): every task ranks its own queries against all
  of it, and nothing is shuffled;
* otherwise both sides are routed to cells. A cell of any size is cut into
  blocks on both sides, block meets block in one bounded task, and only k
  matches per query leave it.

Where tasks share a query, its final rank is a window over at most k rows per
task; Spark prunes it to k per query before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMALS = 6
SMALL_ROWS = 4096
SMALL_BYTES = 64 * 2**20
SLICE_CELLS = 2_000_000
CELL_BLOCKS = 4
TILE = 1024  # rows and columns of rough scores at a time


class Scorer(Protocol):
    """Scores blocks of queries against blocks of the corpus.

    One with ``side_by_side`` is asked for that many queries at a time at most.
    """

    def queries(self, column: pa.Array) -> Any: ...

    def corpus(self, column: pa.Array, queries: Any) -> Any: ...

    def score(self, queries: Any, rows: slice, corpus: Any) -> np.ndarray:
        """A new float64 matrix of scores; minus infinity where there is no match."""


def _column(table: pa.Table | pa.RecordBatch, i: int) -> pa.Array:
    column = table.column(i)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _best(
    scorer: Scorer, q_ids: np.ndarray, q: Any, c_ids: np.ndarray, c: Any, k: int,
    floor: float | None, exclude_same: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query row, corpus row and score of the k best matches per query.

    The rounded score and the place of the id are put into one whole number, so
    that a partial sort of plain numbers gives exactly the k best with ties going
    to the smaller id, and both parts can be read back from it.
    """
    n, unit = len(c_ids), 10**DECIMALS
    if n > 4 * (k + 1) and hasattr(scorer, "likely"):
        return _best_likely(scorer, q_ids, q, c_ids, c, k, floor, exclude_same)
    order = np.argsort(c_ids, kind="stable")
    place = np.empty(n)
    place[order] = np.arange(n)
    if exclude_same:
        at = np.minimum(np.searchsorted(c_ids, q_ids, sorter=order), n - 1)
        same = np.where(c_ids[order[at]] == q_ids, order[at], -1)
    found = ([np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)])
    step, take = max(1, min(SLICE_CELLS // n, getattr(scorer, "side_by_side", None) or len(q_ids))), min(k, n)
    for start in range(0, len(q_ids), step):
        rows = slice(start, min(start + step, len(q_ids)))
        keys = scorer.score(q, rows, c)
        np.fmax(keys, -np.inf, out=keys)  # a score that is no number ranks below all others
        if exclude_same:
            here = np.nonzero(same[rows] >= 0)[0]
            keys[here, same[rows][here]] = -np.inf
        keys *= unit
        np.rint(keys, out=keys)
        if floor is not None:
            keys[keys < np.rint(floor * unit)] = -np.inf
        keys *= n
        keys -= place
        if take < n:
            keys = np.partition(keys, n - take, axis=1)[:, n - take:]
        row, col = np.nonzero(keys > -np.inf)
        key = keys[row, col].astype(np.int64)
        at_place = -key % n
        found[0].append(row + start)
        found[1].append(order[at_place])
        found[2].append((key + at_place) // n / unit)
    return tuple(np.concatenate(parts) for parts in found)


def _ranks(rows: np.ndarray) -> np.ndarray:
    """The place of each entry among those of its row, from 0; ``rows`` rise."""
    return np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")


def _best_likely(
    scorer: Any, q_ids: np.ndarray, q: Any, c_ids: np.ndarray, c: Any, k: int, floor: float | None, exclude_same: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`_best`, for a scorer that can say cheaply which pairs may be among the best.

    ``likely`` gives rough scores, off by less than ``margin``. Tile by tile only pairs
    are kept that reach a query's k-th best rough score so far, less what roughness and
    rounded ties allow; only these are scored exactly. No true match is lost.
    """
    unit, keep = 10**DECIMALS, k + exclude_same
    margin = scorer.margin(q)
    slack = 2.0 * margin + 1.0 / unit
    rough_q, rough_c, q_at, c_at = scorer.likely(q, c)  # rows that can match, and where they stand
    found = ([np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)])
    place = np.empty(len(c_ids), np.int64)
    place[np.argsort(c_ids, kind="stable")] = np.arange(len(c_ids))
    least_allowed = -np.inf if floor is None else floor - margin - 1.0 / unit
    for start in range(0, len(q_at), TILE):
        part = rough_q[start : start + TILE]
        least = np.full(len(part), least_allowed, np.float32)
        rows, cols, scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
        done, due = 0, 0
        while done < len(c_at):
            tile = part @ rough_c[done : done + TILE].T
            if hasattr(scorer, "allowed"):
                tile[~scorer.allowed(q, q_at[start : start + TILE], c, c_at[done : done + TILE])] = -np.inf
            if not done and keep < tile.shape[1]:
                kth = np.partition(tile, tile.shape[1] - keep, axis=1)[:, tile.shape[1] - keep]
                least = np.maximum(least, kth - np.float32(slack))
            at = np.flatnonzero((tile >= least[:, None]) & (tile > -np.inf) if np.isneginf(least).any() else tile >= least[:, None])
            row, col = np.divmod(at, tile.shape[1])
            rows, cols, scores = np.concatenate([rows, row]), np.concatenate([cols, col + done]), np.concatenate([scores, tile.ravel()[at]])
            done += tile.shape[1]
            if done >= due or len(rows) > 8 * keep * len(part):
                due = 2 * done
                order = np.lexsort((-scores, rows))
                rows, cols, scores = rows[order], cols[order], scores[order]
                last = _ranks(rows) == keep - 1
                least[rows[last]] = np.maximum(least[rows[last]], scores[last] - np.float32(slack))
                still = scores >= least[rows]
                rows, cols, scores = rows[still], cols[still], scores[still]
        row, col = q_at[start + rows], c_at[cols]
        if exclude_same:
            other = q_ids[row] != c_ids[col]
            row, col = row[other], col[other]
        key = np.rint(scorer.exact(q, row, c, col) * unit)
        if floor is not None:
            enough = key >= np.rint(floor * unit)
            row, col, key = row[enough], col[enough], key[enough]
        order = np.lexsort((place[col], -key, row))
        order = order[_ranks(row[order]) < k]
        found[0].append(row[order])
        found[1].append(col[order])
        found[2].append(key[order] / unit)
    return tuple(np.concatenate(parts) for parts in found)


def hits_schema(q_id: T.StructField, c_id: T.StructField) -> T.StructType:
    return T.StructType(
        [T.StructField("query_id", q_id.dataType), T.StructField("item_id", c_id.dataType),
         T.StructField("score", T.DoubleType())]
    )


def ranked(hits: DataFrame, k: int) -> DataFrame:
    best_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id")
    return hits.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def _best_rows(table: pa.Table, k: int) -> pa.Table:
    """The k best rows of each ``_row``, in rank order and with their rank."""
    table = table.sort_by([("_row", "ascending"), ("score", "descending"), ("item_id", "ascending")])
    rows = table.column("_row").to_numpy()
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") + 1
    return table.append_column("rank", pa.array(rank, pa.int32())).filter(pa.array(rank <= k))


def _scan_corpus(
    queries: pa.Table, corpus: DataFrame, scorer: Scorer, k: int, floor: float | None,
    exclude_same: bool, schema: T.StructType,
) -> DataFrame:
    """Score the corpus where it lies against a small set of queries."""
    shared = corpus.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_column = _column(shared.value, 0)
        q_ids = q_column.to_numpy(zero_copy_only=False)
        q = scorer.queries(_column(shared.value, 1))
        best: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            c_column = _column(batch, 0)
            row, col, score = _best(
                scorer, q_ids, q, c_column.to_numpy(zero_copy_only=False),
                scorer.corpus(_column(batch, 1), q), k, floor, exclude_same,
            )
            found = pa.table(
                {"query_id": q_column.take(pa.array(row)), "item_id": c_column.take(pa.array(col)),
                 "score": pa.array(score), "_row": pa.array(row)}
            )
            # Keep k per query over all batches of the task, not per batch.
            both = found if best is None else pa.concat_tables([best, found])
            best = _best_rows(both, k).drop_columns(["rank"])
        if best is not None:
            yield from best.drop_columns(["_row"]).combine_chunks().to_batches()

    return corpus.mapInArrow(search, schema)


def _scan_queries(
    queries: DataFrame, corpus: pa.Table, scorer: Scorer, k: int, floor: float | None,
    exclude_same: bool, schema: T.StructType,
) -> DataFrame:
    """Rank the queries where they lie against a small corpus."""
    shared = queries.sparkSession.sparkContext.broadcast(corpus)
    with_rank = T.StructType([*schema.fields, T.StructField("rank", T.IntegerType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c_column = _column(shared.value, 0)
        c_ids = c_column.to_numpy(zero_copy_only=False)
        for batch in batches:
            if not batch.num_rows:
                continue
            q_column = _column(batch, 0)
            q = scorer.queries(_column(batch, 1))
            row, col, score = _best(
                scorer, q_column.to_numpy(zero_copy_only=False), q, c_ids,
                scorer.corpus(_column(shared.value, 1), q), k, floor, exclude_same,
            )
            found = pa.table(
                {"query_id": q_column.take(pa.array(row)), "item_id": c_column.take(pa.array(col)),
                 "score": pa.array(score), "_row": pa.array(row)}
            )
            yield from _best_rows(found, k).drop_columns(["_row"]).combine_chunks().to_batches()

    return queries.mapInArrow(search, with_rank)


def blocked(
    queries: DataFrame, corpus: DataFrame, scorer: Scorer, k: int, floor: float | None,
    exclude_same: bool, schema: T.StructType, block_rows: int, most_rows: int | None = None,
) -> DataFrame:
    """Block against block inside each cell.

    Both inputs are ``cell, id, value``. The number of cells is bounded by the
    router, so the table of cell sizes is small whatever the data. A row is copied for each
    block of the other side, so blocks of ``block_rows`` grow with their cell, up to
    ``most_rows``, once there are more than CELL_BLOCKS of them.
    """
    def rows_in(n):
        return F.greatest(F.lit(block_rows), F.least(F.lit(most_rows or block_rows), F.ceil(n / CELL_BLOCKS)))

    sizes = [
        side.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows_in(F.count(F.lit(1)))).alias(name))
        for side, name in ((queries, "q_blocks"), (corpus, "c_blocks"))
    ]
    blocks = F.broadcast(sizes[0].join(sizes[1], "cell"))

    def placed(side: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(side.columns[1]), F.col(own)).alias(own[0])
        theirs = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[0])
        return side.join(blocks, "cell").select("cell", mine, theirs, *side.columns[1:])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        q_column, c_column = _column(left, 3), _column(right, 3)
        if not left.num_rows or not right.num_rows:
            row = col = np.empty(0, np.int64)
            score = np.empty(0)
        else:
            q = scorer.queries(_column(left, 4))
            row, col, score = _best(
                scorer, q_column.to_numpy(zero_copy_only=False), q,
                c_column.to_numpy(zero_copy_only=False), scorer.corpus(_column(right, 4), q),
                k, floor, exclude_same,
            )
        return pa.table(
            {"query_id": q_column.take(pa.array(row)), "item_id": c_column.take(pa.array(col)),
             "score": pa.array(score)}
        )

    key = ("cell", "q", "c")
    return (
        placed(queries, "q_blocks", "c_blocks").select(*key, *queries.columns[1:]).groupBy(*key)
        .cogroup(
            placed(corpus, "c_blocks", "q_blocks").select(*key, *corpus.columns[1:]).groupBy(*key)
        )
        .applyInArrow(meet, schema)
    )


def is_small(df: DataFrame, max_rows: int, max_bytes: int = SMALL_BYTES) -> bool:
    """True if ``df`` (``id, value``) may be sent to every task.

    Rows and bytes are summed by the executors, so a large input never reaches
    the driver to find out.
    """
    kind = df.schema[1].dataType
    weight = F.size("value") * 8 if isinstance(kind, T.ArrayType) else F.octet_length("value")
    total = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(weight), F.lit(0)).alias("bytes")
    ).first()
    return total["n"] <= max_rows and total["bytes"] <= max_bytes


def small_side(queries: DataFrame, corpus: DataFrame, max_rows: int) -> str | None:
    """``queries`` or ``corpus``, whichever may be sent to every task first."""
    if max_rows and is_small(queries, max_rows):
        return "queries"
    return "corpus" if max_rows and is_small(corpus, max_rows) else None


def topk(
    queries: DataFrame,
    corpus: DataFrame,
    scorer: Scorer,
    k: int,
    floor: float | None = None,
    exclude_same: bool = False,
    route=None,
    small: str | None = None,
    block_rows: int = 8192,
    most_rows: int | None = None,
) -> DataFrame:
    """``query_id, item_id, score, rank`` for inputs of ``id, value``.

    ``small`` is what :func:`small_side` found. For the large case
    ``route(queries, corpus)`` gives both sides a ``cell`` column; without it all
    rows share one cell. It must place every pair that can belong to the result
    in a common cell at least once.
    """
    schema = hits_schema(queries.schema[0], corpus.schema[0])
    if small == "corpus":
        return _scan_queries(queries, corpus.toArrow(), scorer, k, floor, exclude_same, schema)
    if small == "queries":
        hits = _scan_corpus(queries.toArrow(), corpus, scorer, k, floor, exclude_same, schema)
    else:
        if route is None:
            def route(q, c):
                one = F.lit(0).alias("cell")
                return q.select(one, "*"), c.select(one, "*")

        routed = route(queries, corpus)
        hits = blocked(*routed, scorer, k, floor, exclude_same, schema, block_rows, most_rows)
    return ranked(hits, k)
