"""Nearest vectors by cosine: exact, and two approximate searches."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators import topk as engine
from gleanery.operators.sampling import smallest_marks
from gleanery.session import written


# The table of cell sizes is sent to all tasks, so the number of cells is bounded.
MAX_CELLS = 2**16


# Numbers that a portion of an Arrow batch may become, as vectors are copied to many cells.
PORTION_NUMBERS = 4_000_000


# Pairs of vectors that are scored exactly at a time.
PAIRS = 1 << 14


# Bytes of one block of vectors. Larger blocks mean fewer copies of both sides.
BLOCK_BYTES = 32 * 2**20


# Share of the true neighbours that an approximate search finds unless told otherwise, and
# the queries and numbers by which that is measured before the search.
RECALL = 0.9
SAMPLE = 256
SAMPLE_NUMBERS = 4_000_000


# Bounds of what is derived: pivots and planes are sent to all tasks.
DERIVED_CELLS, DERIVED_TABLES, DERIVED_BITS = 4096, 64, 12


def _rows_per_block(block_rows: int | None, dimension: int) -> int:
    return block_rows or max(1024, BLOCK_BYTES // (8 * dimension))


def _busy_rows(corpus: DataFrame, n: int, dimension: int) -> int:
    """Rows of a block: at most what memory allows, and few enough to keep all slots busy."""
    slots = corpus.sparkSession.sparkContext.defaultParallelism
    return max(1024, min(_rows_per_block(None, dimension), int(n / (2 * slots**0.5))))


def unit_rows(column: pa.Array) -> np.ndarray:
    """List column to a float64 matrix of unit rows; NaN where a row has no length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if not len(lengths):
        return np.empty((0, 0))
    width = lengths[0]
    if np.isnan(width) or (lengths != width).any():
        raise ValueError("vectors must be present and all of one dimension")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(lengths), int(width))
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / norm


class CosineScorer:
    """Block score = matrix product of unit rows. Rows without length match nothing."""

    def queries(self, column: pa.Array) -> np.ndarray:
        return unit_rows(column)

    def corpus(self, column: pa.Array, queries: np.ndarray) -> np.ndarray:
        return unit_rows(column)

    def score(self, queries: np.ndarray, rows: slice, corpus: np.ndarray) -> np.ndarray:
        return queries[rows] @ corpus.T

    def likely(self, queries: np.ndarray, corpus: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both sides in half the bytes without rows that match nothing, and where these rows stand."""
        q_at, c_at = (np.flatnonzero(~np.isnan(x).any(axis=1)) for x in (queries, corpus))
        return queries[q_at].astype(np.float32), corpus[c_at].astype(np.float32), q_at, c_at

    def margin(self, queries: np.ndarray) -> float:
        """More than products of short floats can be off, for unit rows."""
        return (queries.shape[1] + 4) * 2.0**-23

    def exact(self, queries: np.ndarray, rows: np.ndarray, corpus: np.ndarray, columns: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows))
        for i in range(0, len(rows), PAIRS):
            out[i : i + PAIRS] = np.einsum("nd,nd->n", queries[rows[i : i + PAIRS]], corpus[columns[i : i + PAIRS]])
        return out


class CelledScorer(CosineScorer):
    """Cosine within the cells that a query looks into.

    A query is its vector and a bit for each cell of the group, a corpus row its vector and
    its cell's place in the group.
    """

    def queries(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        looks = np.frombuffer(b"".join(column.field("looks").to_pylist()), np.uint8).reshape(len(column), -1)
        return unit_rows(column.field("vector")), np.unpackbits(looks, axis=1).view(bool)

    def corpus(self, column: pa.Array, queries) -> tuple[np.ndarray, np.ndarray]:
        return unit_rows(column.field("vector")), column.field("home").to_numpy(zero_copy_only=False)

    def score(self, queries, rows: slice, corpus) -> np.ndarray:
        return np.where(queries[1][rows][:, corpus[1]], queries[0][rows] @ corpus[0].T, -np.inf)

    def likely(self, queries, corpus):
        return super().likely(queries[0], corpus[0])

    def margin(self, queries) -> float:
        return super().margin(queries[0])

    def exact(self, queries, rows: np.ndarray, corpus, columns: np.ndarray) -> np.ndarray:
        return super().exact(queries[0], rows, corpus[0], columns)

    def allowed(self, queries, rows: np.ndarray, corpus, columns: np.ndarray) -> np.ndarray:
        return queries[1][rows][:, corpus[1][columns]]


def _is_finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _pair(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, value`` of rows that have a vector. Other odd rows become NaN in :func:`unit_rows`."""
    return df.select(F.col(key).alias("id"), F.col(vector).alias("value")).where(F.col("value").isNotNull())


def search_coverage(df: DataFrame, vector: str) -> DataFrame:
    """One row: how many rows a search can find, and why the others cannot be found."""
    v = F.col(vector)
    is_null, finite = v.isNull(), F.coalesce(_is_finite(v), F.lit(False))
    any_length = F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    count = lambda c: F.count(F.when(c, 1))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count(is_null).alias("null_vectors"),
        count(~is_null & ~finite).alias("non_finite_vectors"),
        count(finite & ~any_length).alias("zero_vectors"),
        count(finite & any_length).alias("searchable"),
    )


def _routed_schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("cell", T.IntegerType()), *df.schema.fields])


def _emit(batch: pa.RecordBatch, rows: np.ndarray, cells: np.ndarray, extra=()) -> pa.RecordBatch:
    taken = batch.take(pa.array(rows.astype(np.int64)))
    columns = [pa.array(cells.astype(np.int32)), *taken.columns, *(c for _, c in extra)]
    return pa.RecordBatch.from_arrays(
        columns, ["cell", *batch.schema.names, *(n for n, _ in extra)]
    )


def _portions(batches: Iterator[pa.RecordBatch], copies: int) -> Iterator[pa.RecordBatch]:
    """The batches in portions, small enough for ``copies`` of each row's vector (the second column)."""
    for batch in batches:
        if batch.num_rows:
            numbers = len(batch.column(1).flatten()) // batch.num_rows  # of a vector
            step = max(1, PORTION_NUMBERS // (max(1, copies) * max(1, numbers)))
            for i in range(0, batch.num_rows, step):
                yield batch.slice(i, step)


def _chord(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def _searchable(rows: np.ndarray) -> np.ndarray:
    return rows[~np.isnan(rows).any(axis=1)]


def _pivots(corpus: DataFrame, cells: int) -> np.ndarray:
    """Up to ``cells`` different corpus vectors, picked by the hash of their id."""
    if not 0 < cells <= MAX_CELLS:
        raise ValueError(f"cells must lie between 1 and {MAX_CELLS}")
    # Some more are asked for, as copies would take up cells for nothing.
    picked = smallest_marks(corpus, "id", 4 * cells).select("value")
    rows = _searchable(unit_rows(picked.toArrow().column(0).combine_chunks()))
    _, first = np.unique(rows, axis=0, return_index=True)
    return rows[np.sort(first)[:cells]]


def _home_cells(corpus: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each vector with its nearest pivot and the distance to it."""
    schema = T.StructType([*_routed_schema(corpus).fields, T.StructField("away", T.DoubleType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches, -(-len(pivots) // 8)):  # distances weigh less than copies
            away = _chord(unit_rows(batch.column(1)), pivots)
            home = away.argmin(axis=1)
            rows = np.flatnonzero(~np.isnan(away).any(axis=1))
            home = home[rows]
            yield _emit(batch, rows, home, [("away", pa.array(away[rows, home]))])

    return corpus.mapInArrow(assign, schema)


def _visit(queries: DataFrame, wanted, cells: int) -> DataFrame:
    """Send each query to those of ``cells`` for which ``wanted(unit rows)`` is true."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches, cells):
            unit = unit_rows(batch.column(1))
            rows, at = np.nonzero(wanted(unit) & ~np.isnan(unit).any(axis=1)[:, None])
            yield _emit(batch, rows, at)

    return queries.mapInArrow(send, _routed_schema(queries))


def _visit_groups(queries: DataFrame, wanted, bounds: np.ndarray) -> DataFrame:
    """``cell, id, value``: a query once for each group of neighbouring cells that has a wanted one.

    ``bounds`` are the first cells of the groups and the number of all cells; ``value`` is
    the vector with a bit for each cell of the group.
    """
    value = T.StructType([T.StructField("vector", queries.schema[1].dataType), T.StructField("looks", T.BinaryType())])
    schema = T.StructType([T.StructField("cell", T.IntegerType()), queries.schema[0], T.StructField("value", value)])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches, max(1, bounds[-1] // 8)):
            unit = unit_rows(batch.column(1))
            looks = wanted(unit) & ~np.isnan(unit).any(axis=1)[:, None]
            for group, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                rows = np.flatnonzero(looks[:, low:high].any(axis=1))
                bits = [b.tobytes() for b in np.packbits(looks[rows, low:high], axis=1)]
                taken = batch.take(pa.array(rows))
                values = pa.StructArray.from_arrays([taken.column(1), pa.array(bits, pa.binary())], ["vector", "looks"])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), group, np.int32)), taken.column(0), values], ["cell", "id", "value"])

    return queries.mapInArrow(send, schema)


def _exact_route(k: int, floor: float | None, exclude_same: bool, cells: int):
    """Route by the triangle inequality: skip only cells that cannot hold a hit.

    A cell is a pivot, the number of vectors nearest to it and the greatest
    distance among them. Taking cells by their far edge until k vectors are
    covered bounds the distance of a query's k-th match; a cell whose near edge
    lies beyond that bound is skipped. Rounded scores tie, hence the slack.
    """
    slack = 4.0 * 10.0**-engine.DECIMALS
    needed = k + 1 if exclude_same else k

    def route(queries: DataFrame, corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
        pivots = _pivots(corpus, cells)
        homes = _home_cells(corpus, pivots)
        count, radius = np.zeros(len(pivots)), np.zeros(len(pivots))
        stats = homes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r"))
        for row in stats.toLocalIterator():  # one row per cell
            count[row["cell"]], radius[row["cell"]] = row["n"], row["r"]

        def wanted(q: np.ndarray) -> np.ndarray:
            away = _chord(q, pivots)
            far = np.where(count > 0, away + radius, np.inf)
            order = np.argsort(far, axis=1)
            covered = np.cumsum(count[order], axis=1) >= needed
            at = np.where(covered.any(axis=1), covered.argmax(axis=1), len(pivots) - 1)
            bound = np.take_along_axis(far, np.take_along_axis(order, at[:, None], 1), 1)
            bound = np.where(covered.any(axis=1)[:, None], bound, np.inf)
            if floor is not None:
                bound = np.minimum(bound, np.sqrt(max(2.0 - 2.0 * floor, 0.0)))
            near = np.maximum(away - radius, 0.0)
            return (near <= np.sqrt(bound**2 + slack)) & (count > 0)

        return _visit(queries, wanted, len(pivots)), homes.drop("away")

    return route


def exact_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vector: str = "vector",
    corpus_id: str = "chunk_id",
    corpus_vector: str = "vector",
    min_score: float | None = None,
    exclude_same: bool = False,
    cells: int | None = None,
    max_small_rows: int = engine.SMALL_ROWS,
    block_rows: int | None = None,
) -> DataFrame:
    """The k nearest corpus vectors of every query: ``query_id, item_id, score, rank``.

    Scores are rounded to six places and ties go to the smaller id. Filter the
    corpus before the call; the filter reaches its scan. Vectors without length
    have no cosine and match nothing. More ``cells`` rule out more of a clustered
    corpus; by default there are four to a block, up to 256.
    """
    q, c = _pair(queries, query_id, query_vector), _pair(corpus, corpus_id, corpus_vector)
    small = engine.small_side(q, c, max_small_rows)
    if small is None:
        corpus_is = c.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("value")).alias("dimension")).first()
        block_rows = block_rows or _busy_rows(c, corpus_is["n"], corpus_is["dimension"] or 1)
        # Each visited cell costs a copy of the query, so a cell should be worth it.
        cells = cells or min(256, max(1, 4 * corpus_is["n"] // block_rows))
    return engine.topk(
        q, c, CosineScorer(), k, min_score, exclude_same,
        _exact_route(k, min_score, exclude_same, cells), small, block_rows or 1,
        None if small else _rows_per_block(None, corpus_is["dimension"] or 1),
    )


def sign_planes(dimension: int, bits: int, tables: int) -> np.ndarray:
    """Hyperplanes of +1 and -1, from a hash so that any engine can rebuild them."""
    names = (f"{t}/{b}/{i}" for t in range(tables) for b in range(bits) for i in range(dimension))
    signs = [1.0 if md5(n.encode()).hexdigest()[0] < "8" else -1.0 for n in names]
    return np.array(signs).reshape(tables, bits, dimension)


def _distinct_hits(hits: DataFrame, k: int) -> DataFrame:
    once = hits.groupBy("query_id", "item_id").agg(F.max("score").alias("score"))
    return engine.ranked(once, k)


def _true_pairs(q: DataFrame, c: DataFrame, k: int, exclude_same: bool) -> tuple[np.ndarray, np.ndarray, float]:
    """Unit rows of sampled queries and of their k true neighbours, pair by pair, and the share to be found.

    Queries are picked by the hash of their id and searched exactly. The share lies two
    standard errors above the recall wanted, as the sample may be lucky.
    """
    first = c.select(F.size("value")).first()
    size = max(32, min(SAMPLE, SAMPLE_NUMBERS // (k * max(1, first[0] if first else 1))))
    asked = written(smallest_marks(q, "id", size), "recall-sample")
    hits = exact_search(asked, c, k, "id", "value", "id", "value", exclude_same=exclude_same)
    # hits and sample are few and go to the corpus, none of which is shuffled
    items = c.select(F.col("id").alias("item_id"), F.col("value").alias("item")).join(F.broadcast(hits), "item_id")
    found = items.join(F.broadcast(asked.select(F.col("id").alias("query_id"), "value")), "query_id").select("query_id", "value", "item").toArrow().combine_chunks()
    if not found.num_rows:
        return np.empty((0, 0)), np.empty((0, 0)), 1.0
    queries = len(found.column(0).unique())
    share = min(1.0, RECALL + 2.0 * (RECALL * (1.0 - RECALL) / queries) ** 0.5)
    return unit_rows(found.column(1).combine_chunks()), unit_rows(found.column(2).combine_chunks()), share


def _probes_for(pivots: np.ndarray, asked: np.ndarray, items: np.ndarray, share: float) -> int:
    """The fewest cells that hold the share of true neighbours; all of them where there is no sample."""
    if not len(asked):
        return len(pivots)
    place = _chord(asked, pivots).argsort(axis=1).argsort(axis=1)
    needed = np.sort(place[np.arange(len(items)), _chord(items, pivots).argmin(axis=1)] + 1)
    return int(needed[int(np.ceil(share * len(needed))) - 1])


def _hashing_for(
    rows: int, dimension: int, asked: np.ndarray, items: np.ndarray, share: float, bits: int | None, tables: int | None,
) -> tuple[int, int]:
    """The bits and tables that compare least, tables / 2**bits, and meet the share of true neighbours.

    One table without bits compares everything, so the share is always met unless one
    of the two is given.
    """
    best, least = ((0, 1), 1.0) if bits is None else ((bits, tables or 1), float("inf"))
    if len(asked):
        most = max(1, min(DERIVED_BITS, int(rows).bit_length() - 3))
        choices = [bits] if bits is not None else range(1, most + 1)
        planes = sign_planes(dimension, max(choices), tables or DERIVED_TABLES)
        signs = [np.einsum("nd,tbd->ntb", x, planes) >= 0 for x in (asked, items)]
        same = signs[0] == signs[1]
        for b in choices:
            met = np.logical_or.accumulate(same[:, :, :b].all(axis=2), axis=1).mean(axis=0)
            enough = np.flatnonzero(met >= share)
            t = tables or (int(enough[0]) + 1 if len(enough) else None)
            if len(enough) and t << b <= MAX_CELLS and t / (1 << b) < least:
                best, least = (b, t), t / (1 << b)
        if least == float("inf"):
            raise ValueError(f"{bits} bits do not reach a recall of {RECALL} with {tables or DERIVED_TABLES} tables; leave bits out")
    elif bits is not None:
        best = (bits, tables or DERIVED_TABLES)
    return best


def hashed_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    dimension: int,
    bits: int | None = None,
    tables: int | None = None,
    query_id: str = "query_id",
    query_vector: str = "vector",
    corpus_id: str = "chunk_id",
    corpus_vector: str = "vector",
    exclude_same: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Approximate search by random hyperplanes, with exact scores for what is found.

    A vector gets one bucket per table, the sign pattern of its dot products.
    Vectors that share a bucket are compared; a crowded bucket is cut into blocks. What
    is not given of ``bits`` and ``tables`` follows from the row count and from the true
    neighbours of a sample of the queries, such that ``RECALL`` of them are found. Where
    hashing saves nothing, everything is compared.
    """
    q, c = _pair(queries, query_id, query_vector), _pair(corpus, corpus_id, corpus_vector)
    if bits is None or tables is None:
        bits, tables = _hashing_for(c.count(), dimension, *_true_pairs(q, c, k, exclude_same), bits, tables)
    if tables << bits > MAX_CELLS:
        raise ValueError(f"tables * 2**bits must not exceed {MAX_CELLS}")
    planes = sign_planes(dimension, bits, tables)
    weights = 1 << np.arange(bits)

    def buckets(vectors: np.ndarray) -> np.ndarray:
        patterns = np.einsum("nd,tbd->ntb", vectors, planes) >= 0
        return patterns @ weights + np.arange(tables)[None, :] * (1 << bits)

    def place(side: DataFrame) -> DataFrame:
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _portions(batches, tables):
                cells = buckets(unit_rows(batch.column(1)))
                yield _emit(batch, np.repeat(np.arange(batch.num_rows), tables), cells.ravel())

        return side.mapInArrow(send, _routed_schema(side))

    hits = engine.blocked(
        place(q), place(c), CosineScorer(), k, None, exclude_same,
        engine.hits_schema(q.schema[0], c.schema[0]), _rows_per_block(block_rows, dimension),
    )
    return _distinct_hits(hits, k)


def celled_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    cells: int | None = None,
    probes: int | None = None,
    query_id: str = "query_id",
    query_vector: str = "vector",
    corpus_id: str = "chunk_id",
    corpus_vector: str = "vector",
    exclude_same: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Approximate search in the ``probes`` cells nearest to each query.

    By default there are as many cells as the root of the row count, and as many probes as
    find ``RECALL`` of the true neighbours of a sample of the queries. Cells are compared in
    groups of about ``block_rows`` vectors, so that a query travels once to a group and not to each cell.
    """
    q, c = _pair(queries, query_id, query_vector), _pair(corpus, corpus_id, corpus_vector)
    n = c.count()
    pivots = _pivots(c, cells or max(1, min(DERIVED_CELLS, round(n**0.5))))
    if probes is None:
        probes = _probes_for(pivots, *_true_pairs(q, c, k, exclude_same))

    def wanted(vectors: np.ndarray) -> np.ndarray:
        rank = _chord(vectors, pivots).argsort(axis=1).argsort(axis=1)
        return rank < probes

    block_rows = block_rows or _busy_rows(c, n, pivots.shape[1])
    groups = max(1, min(len(pivots), -(-n // block_rows)))
    bounds = np.arange(groups + 1) * len(pivots) // groups
    group_of = np.searchsorted(bounds, np.arange(len(pivots)), side="right") - 1
    places = F.array(*[F.lit(int(g)) for g in group_of]), F.array(*[F.lit(int(i - bounds[g])) for i, g in enumerate(group_of)])
    group, home = (F.get(p, F.col("cell")) for p in places)
    homes = _home_cells(c, pivots).select(group.alias("cell"), "id", F.struct(F.col("value").alias("vector"), home.alias("home")).alias("value"))
    hits = engine.blocked(
        _visit_groups(q, wanted, bounds), homes, CelledScorer(), k, None, exclude_same, engine.hits_schema(q.schema[0], c.schema[0]), block_rows,
    )
    return engine.ranked(hits, k)


def search_recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that the approximate search found, per query."""
    found = approximate.select("query_id", "item_id", F.lit(1).alias("found"))
    joined = exact.select("query_id", "item_id").join(found, ["query_id", "item_id"], "left")
    return joined.groupBy("query_id").agg(
        (F.count("found") / F.count(F.lit(1))).alias("recall")
    )


def with_columns_of(hits: DataFrame, corpus: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fetch text and metadata for the hits only, after the search.

    The hits are written first. While they are few, Spark sees that from the
    table and sends them to the corpus; the texts themselves are not shuffled.
    """
    return written(hits, "hits").join(corpus.select(F.col(key).alias("item_id"), *columns), "item_id")


def with_score_floor(hits: DataFrame, floor: float) -> DataFrame:
    """Drop hits below a score and number the rest again from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id")
    return hits.where(F.col("score") >= floor).withColumn("rank", F.row_number().over(order))
