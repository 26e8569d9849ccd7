"""A kept vector index: cells of nearby vectors, each vector as a short code.

Building it learns cells (k-means) and, for what is left of a vector after its cell's
centre is taken off, a codebook for each part of its components (product quantisation).
Every vector is stored in the partition of its cell as its code beside the full vector.
A search reads the codes of the cells nearest to each query, scores them by the distance
to the vectors that they stand for, and scores only the best few exactly. Many queries are
dealt into blocks of neighbours, and each block meets the cells that one of its queries
looks into, in one task that keeps the best few. A change feed rewrites the cells that it
touches and no others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators import sync, vector_search
from gleanery.operators import topk as engine
from gleanery.operators.sampling import smallest_marks
from gleanery.operators.vector_search import RECALL, unit_rows
from gleanery.session import written

TRAIN_ROWS = 16_384  # at most so many vectors are learnt from
TRAIN_NUMBERS = 8_000_000
ROUNDS = 12
CODES = 256
MAX_CELLS = 4096

# A block of queries: its rows, the matches held for it, its marks of cells to look into; the numbers of a portion
# of vectors that it meets, and of rough scores at a time.
BLOCK_QUERIES = 32_768
BLOCK_MATCHES = 1 << 21
BLOCK_LOOKS = 1 << 25
MEET_NUMBERS = 1 << 21
TILE_NUMBERS = 1 << 22


@dataclass(frozen=True)
class Model:
    """Cell centres, codebooks (part, code, component), and how far a search looks by default."""

    centres: np.ndarray
    books: np.ndarray
    probes: int
    shortlist: int

    @property
    def dimension(self) -> int:
        return self.centres.shape[1]

    def cells_of(self, unit: np.ndarray) -> np.ndarray:
        return _distances(unit, self.centres).argmin(axis=1)

    def encode(self, unit: np.ndarray, cells: np.ndarray) -> np.ndarray:
        parts, codes, width = self.books.shape
        left = np.zeros((len(unit), parts * width))
        left[:, : self.dimension] = unit - self.centres[cells]
        out = np.empty((len(unit), parts), np.uint8)
        for p in range(parts):
            out[:, p] = _distances(left[:, p * width : (p + 1) * width], self.books[p]).argmin(axis=1)
        return out

    def decode(self, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        parts, _, width = self.books.shape
        left = np.empty((len(cells), parts * width))
        for p in range(parts):
            left[:, p * width : (p + 1) * width] = self.books[p][codes[:, p]]
        return left[:, : self.dimension] + self.centres[cells]

    def nearest(self, unit: np.ndarray, probes: int) -> np.ndarray:
        """For each row a mask over the cells to look into."""
        away = _distances(unit, self.centres)
        if probes >= away.shape[1]:
            return np.ones(away.shape, bool)
        looks = away <= np.partition(away, probes - 1, axis=1)[:, probes - 1 : probes]
        tied = np.flatnonzero(looks.sum(axis=1) > probes)
        looks[tied] = away[tied].argsort(axis=1, kind="stable").argsort(axis=1) < probes
        return looks


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(axis=1) - 2.0 * rows @ centres.T


def k_means(rows: np.ndarray, k: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``k`` centres. An empty cell takes the row that lies furthest from its centre."""
    rng = np.random.default_rng(seed)
    different = np.unique(rows, axis=0)
    if len(different) <= k:
        return different
    centres = different[np.sort(rng.choice(len(different), k, replace=False))]
    for _ in range(rounds):
        home = _distances(rows, centres).argmin(axis=1)
        count = np.bincount(home, minlength=k)
        order = np.argsort(home, kind="stable")
        sums = np.add.reduceat(rows[order], np.minimum(np.cumsum(count) - count, len(rows) - 1), axis=0)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            far = ((rows - centres[home]) ** 2).sum(axis=1).argsort()[::-1]
            centres[empty] = rows[far[: len(empty)]]
    return centres


def learn(rows: np.ndarray, cells: int, parts: int, codes: int = CODES) -> tuple[np.ndarray, np.ndarray]:
    """Centres and codebooks from unit rows."""
    centres = k_means(rows, cells, seed=1)
    left = rows - centres[_distances(rows, centres).argmin(axis=1)]
    width = -(-rows.shape[1] // parts)
    padded = np.zeros((len(rows), parts * width))
    padded[:, : rows.shape[1]] = left
    books = []
    for p in range(parts):
        book = k_means(padded[:, p * width : (p + 1) * width], codes, seed=2 + p)
        books.append(np.concatenate([book, np.repeat(book[:1], codes - len(book), axis=0)]))
    return centres, np.stack(books)


class CodeScorer:
    """Approximate cosine from codes; a query meets only the cells that it looks into.

    It is the cosine that follows from the distance between the query and the vector that a
    code stands for. Their product alone would say less: what codes are off along the
    direction that a cell's vectors share can outweigh all that tells these apart.
    """

    def __init__(self, model: Broadcast, probes: int):
        self.model, self.probes = model, probes

    def queries(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        model, unit = Model(*self.model.value), unit_rows(column)
        if not len(unit):
            return np.zeros((0, model.dimension)), np.zeros((0, len(model.centres)), bool)
        return unit, model.nearest(unit, self.probes)

    def corpus(self, column: pa.Array, queries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors, what each adds to its product with a query, and cells; a value is four bytes of cell and one for each part."""
        raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
        cells = raw[:, :4].copy().view("<i4")[:, 0]
        rows = Model(*self.model.value).decode(cells, raw[:, 4:])
        return rows, (1.0 - (rows * rows).sum(axis=1)) / 2.0, cells

    def score(self, queries, rows: slice, corpus) -> np.ndarray:
        return np.where(queries[1][rows][:, corpus[2]], queries[0][rows] @ corpus[0].T + corpus[1], -np.inf)

    def likely(self, queries, corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both sides in half the bytes, what a vector adds as one more component."""
        q_at = np.flatnonzero(~np.isnan(queries[0]).any(axis=1))
        sides = np.ones((len(q_at), queries[0].shape[1] + 1), np.float32), np.empty((len(corpus[0]), corpus[0].shape[1] + 1), np.float32)
        sides[0][:, :-1], sides[1][:, :-1], sides[1][:, -1] = queries[0][q_at], corpus[0], corpus[1]
        return *sides, q_at, np.arange(len(corpus[0]))

    def margin(self, queries) -> float:
        """More than products of short floats can be off, for the longest vector that a code can stand for."""
        centres, books = self.model.value[:2]
        longest = np.sqrt((centres * centres).sum(axis=1).max()) + np.sqrt((books * books).sum(axis=2).max(axis=1).sum())
        return (centres.shape[1] + 5) * 2.0**-23 * (1.0 + longest) ** 2

    def exact(self, queries, rows: np.ndarray, corpus, columns: np.ndarray) -> np.ndarray:
        return vector_search.CosineScorer().exact(queries[0], rows, corpus[0], columns) + corpus[1][columns]

    def allowed(self, queries, rows: np.ndarray, corpus, columns: np.ndarray) -> np.ndarray:
        return queries[1][rows][:, corpus[2][columns]]


class Shortlists:
    """The best matches by code of a block of queries among the vectors met so far, with their exact scores."""

    def __init__(self, ids: pa.Array, vectors: pa.Array, scorer: CodeScorer, shortlist: int, exclude_same: bool):
        self.ids, self.queries, self.scorer = ids, scorer.queries(vectors), scorer
        self.shortlist, self.exclude_same = shortlist, exclude_same
        self.items: pa.Array | None = None
        self.row, self.at, self.key, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)

    def meet(self, ids: pa.Array, vectors: pa.Array, codes: pa.Array) -> None:
        # of vectors with one code, however many, only the smallest ids can come into a shortlist
        code, id_ = codes.dictionary_encode().indices.to_numpy(), ids.to_numpy(zero_copy_only=False)
        order = np.argsort(id_, kind="stable")
        order = order[np.argsort(code[order], kind="stable")]
        first = pa.array(np.sort(order[engine._ranks(code[order]) < self.shortlist + self.exclude_same]))
        ids, vectors, codes = ids.take(first), vectors.take(first), codes.take(first)
        row, col, key = self._found(ids.to_numpy(zero_copy_only=False), self.scorer.corpus(codes, self.queries))
        score = np.round(vector_search.CosineScorer().exact(self.queries[0], row, unit_rows(vectors), col), engine.DECIMALS)
        self.items = ids if self.items is None else pa.concat_arrays([self.items, ids])
        self.row, self.at = np.concatenate([self.row, row]), np.concatenate([self.at, col + len(self.items) - len(ids)])
        self.key, self.score = np.concatenate([self.key, key]), np.concatenate([self.score, score])
        self._keep(self.key, self.shortlist)

    def _found(self, c_ids: np.ndarray, corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query row, vector and rounded score of the matches that may come into a shortlist.

        Rough scores, off by less than the margin, say which pairs to score.
        """
        scorer, unit, keep, q_ids = self.scorer, 10**engine.DECIMALS, self.shortlist + self.exclude_same, self.ids.to_numpy(zero_copy_only=False)
        slack = 2.0 * scorer.margin(self.queries) + 1.0 / unit
        least = np.full(len(q_ids), np.inf)
        np.minimum.at(least, self.row, self.key)
        least[np.bincount(self.row, minlength=len(q_ids)) < self.shortlist] = -np.inf
        rough_q, rough_c, q_at, _ = scorer.likely(self.queries, corpus)
        found = ([np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)])
        step = max(1, TILE_NUMBERS // len(c_ids))
        for start in range(0, len(q_at), step):
            at = q_at[start : start + step]
            rough = rough_q[start : start + step] @ rough_c.T
            rough[~scorer.allowed(self.queries, at, corpus, slice(None))] = np.nan  # compares as false
            near = np.flatnonzero(rough >= (least[at] / unit - slack).astype(np.float32)[:, None])
            if keep < len(c_ids) and len(near) > 2 * keep * len(at):
                kth = np.partition(np.nan_to_num(rough, copy=False, nan=-np.inf), len(c_ids) - keep, axis=1)[:, len(c_ids) - keep]
                near = near[rough.ravel()[near] >= (kth - np.float32(slack))[near // len(c_ids)]]
            row, col = np.divmod(near, len(c_ids))
            row = at[row]
            if self.exclude_same:
                other = q_ids[row] != c_ids[col]
                row, col = row[other], col[other]
            key = np.rint(scorer.exact(self.queries, row, corpus, col) * unit)
            still = key >= least[row]
            for all_, part in zip(found, (row[still], col[still], key[still]), strict=True):
                all_.append(part)
        return tuple(np.concatenate(parts) for parts in found)

    def _keep(self, by: np.ndarray, k: int) -> None:
        """The k best of each query, ties to the smaller id."""
        used, at = np.unique(self.at, return_inverse=True)
        items = self.items.take(pa.array(used))
        place = np.empty(len(items), np.int64)
        place[np.argsort(items.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(items))
        order = np.lexsort((place[at], -by, self.row))
        order = order[engine._ranks(self.row[order]) < k]
        self.items, self.at = items, at[order]
        self.row, self.key, self.score = self.row[order], self.key[order], self.score[order]

    def best(self, k: int) -> pa.RecordBatch:
        self._keep(self.score, k)
        columns = [self.ids.take(pa.array(self.row)), self.items.take(pa.array(self.at)), pa.array(self.score)]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "item_id", "score"])


def _rows_path(path: str) -> str:
    return f"{path}/cells"


def _save_model(spark: SparkSession, path: str, model: Model) -> None:
    row = (model.centres.tobytes(), list(model.centres.shape), model.books.tobytes(), list(model.books.shape), model.probes, model.shortlist)
    schema = "centres binary, centres_shape array<int>, books binary, books_shape array<int>, probes int, shortlist int"
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> Model:
    r = spark.read.parquet(f"{path}/model").head()
    return Model(np.frombuffer(r[0]).reshape(r[1]), np.frombuffer(r[2]).reshape(r[3]), r[4], r[5])


def _shared(spark: SparkSession, model: Model) -> Broadcast:
    """The model's fields alone: a broadcast object would ask for its class on each worker."""
    return spark.sparkContext.broadcast((model.centres, model.books, model.probes, model.shortlist))


def _coded(rows: DataFrame, model: Model) -> DataFrame:
    """``cell, id, value, code`` of rows that can be searched."""
    shared = _shared(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = unit_rows(batch.column(1))
            at = np.flatnonzero(~np.isnan(unit).any(axis=1))
            cells = model.cells_of(unit[at])
            codes = np.concatenate([cells.astype("<i4")[:, None].view(np.uint8), model.encode(unit[at], cells)], axis=1)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int32()), *taken.columns, pa.array([c.tobytes() for c in codes], pa.binary())], names=["cell", "id", "value", "code"]
            )

    fields = [T.StructField("cell", T.IntegerType()), *rows.schema.fields, T.StructField("code", T.BinaryType())]
    return rows.mapInArrow(run, T.StructType(fields))


def _write_cells(rows: DataFrame, path: str, mode: str) -> None:
    """Replace the partitions of the cells that ``rows`` has; a large cell becomes several files."""
    writer = rows.hint("rebalance", "cell").write.mode(mode).partitionBy("cell")
    writer.option("partitionOverwriteMode", "dynamic").parquet(_rows_path(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``cell, id, value, code`` of all vectors."""
    return spark.read.parquet(_rows_path(path)).where("id IS NOT NULL")


def build_index(
    corpus: DataFrame, path: str, key: str = "chunk_id", vector: str = "vector", k: int = 5, cells: int | None = None,
    parts: int | None = None, codes: int = CODES,
) -> Model:
    """Write the index below ``path`` (empty or new) and return its model.

    Cells (by default the root of the row count, at most MAX_CELLS) and codebooks are
    learnt from at most TRAIN_ROWS vectors, picked by the hash of their id; every vector
    is stored. Rows whose vector is null, has a component that is no number or has no
    length are left out, null ids too. How many cells a search looks into and how many vectors it
    scores again follow from the measured recall for ``k`` hits of sampled vectors, which
    is to reach RECALL; a corpus without clusters makes that most of the cells.
    """
    spark = corpus.sparkSession
    rows = vector_search._pair(corpus, key, vector).where("id IS NOT NULL")
    n, first = rows.count(), rows.select(F.size("value")).first()
    if first is None:
        raise ValueError("an index is learnt from vectors; there are none")
    dimension = first[0]
    sample = smallest_marks(rows, "id", max(256, min(TRAIN_ROWS, TRAIN_NUMBERS // dimension))).select("value")
    known = unit_rows(sample.toArrow().column(0).combine_chunks())
    known = known[~np.isnan(known).any(axis=1)]
    if not len(known):
        raise ValueError("an index is learnt from vectors; none of the sampled ones can be searched")
    centres, books = learn(known, cells or max(1, min(MAX_CELLS, round(n**0.5))), parts or max(1, dimension // 4), codes)
    model = Model(centres, books, len(centres), 20 * k)
    _write_cells(_coded(rows, model), path, "overwrite")
    model = _fitted(spark, path, model, k)
    _save_model(spark, path, model)
    return model


def _fitted(spark: SparkSession, path: str, model: Model, k: int) -> Model:
    """The model with the fewest cells and vectors to look at that reach the recall on sampled vectors."""
    rows = read_index(spark, path)
    asked, items, share = vector_search._true_pairs(rows.select("id", "value"), rows.select("id", "value"), k, True)
    if not len(asked):
        return model
    place = _distances(asked, model.centres).argsort(axis=1, kind="stable").argsort(axis=1)
    needed = np.sort(place[np.arange(len(items)), model.cells_of(items)] + 1)
    probes = int(needed[min(len(needed), int(np.ceil(share * len(needed)))) - 1])
    queries = written(smallest_marks(rows.select("id", "value"), "id", vector_search.SAMPLE), "index-sample")
    exact = written(vector_search.exact_search(queries, rows, k, "id", "value", "id", "value", exclude_same=True), "index-exact")
    shortlist, cells = 4 * k, len(model.centres)
    while True:
        model = Model(model.centres, model.books, probes, shortlist)
        hits = _search(queries, rows, model, k, probes, shortlist, "id", "value", True)
        mean = vector_search.search_recall(hits, exact).agg(F.avg("recall")).head()[0]
        if mean is None or mean >= share or (probes == cells and shortlist >= 1024 * k):
            return model
        shortlist = min(2 * shortlist, 1024 * k)
        probes = min(cells, probes + max(1, probes // 4)) if shortlist >= 16 * k else probes


def _search(
    queries: DataFrame, rows: DataFrame, model: Model, k: int, probes: int, shortlist: int, query_id: str, query_vector: str, exclude_same: bool,
) -> DataFrame:
    asked = written(vector_search._pair(queries, query_id, query_vector).where("id IS NOT NULL"), "index-queries")
    scorer = CodeScorer(_shared(queries.sparkSession, model), probes)
    if engine.is_small(asked, engine.SMALL_ROWS):
        hits = _few_queries(asked, rows, model, scorer, shortlist, exclude_same)
    else:
        hits = _many_queries(asked, rows, model, scorer, k, shortlist, exclude_same)
    return engine.ranked(hits, k)


def _of_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows of the partitions named."""
    wanted = [r[0] for r in cells.select("cell").distinct().collect()]  # at most the cells
    return rows.where(F.col("cell").isin(wanted)) if wanted else rows.limit(0)


def _few_queries(asked: DataFrame, rows: DataFrame, model: Model, scorer: CodeScorer, shortlist: int, exclude_same: bool) -> DataFrame:
    """Codes are scored where they lie, against all queries; only full vectors of the shortlists are fetched."""
    inside = _of_cells(rows, vector_search._visit(asked, lambda unit: model.nearest(unit, scorer.probes), len(model.centres)))
    coded = inside.select("id", F.col("code").alias("value"))
    found = written(engine.topk(asked, coded, scorer, shortlist, None, exclude_same, small="queries").select("query_id", "item_id"), "index-shortlist")
    items = sync.KeyFilter(found, "item_id").rows(inside.select(F.col("id").alias("item_id"), F.col("value").alias("item")), True)
    pairs = items.join(found, "item_id").join(F.broadcast(asked.select(F.col("id").alias("query_id"), "value")), "query_id")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = (unit_rows(batch.column(2)) * unit_rows(batch.column(3))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.round(scores, engine.DECIMALS))], names=["query_id", "item_id", "score"])

    return pairs.select("query_id", "item_id", "value", "item").mapInArrow(exact, engine.hits_schema(asked.schema[0], rows.schema["id"]))


def neighbourhoods(centres: np.ndarray, weights: np.ndarray, most: float) -> np.ndarray:
    """A group for each cell: nearby cells that together weigh ``most`` at most, or one cell that weighs more."""
    group, groups, left = np.zeros(len(centres), np.int64), 0, [np.arange(len(centres))]
    while left:
        cells = left.pop()
        if len(cells) == 1 or weights[cells].sum() <= most:
            group[cells], groups = groups, groups + 1
            continue
        far = _distances(centres[cells], k_means(centres[cells], 2, seed=0)).argmin(axis=1) > 0
        if far.all() or not far.any():
            far = np.arange(len(cells)) * 2 >= len(cells)
        left += [cells[far], cells[~far]]
    return group


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that are alike in the first two columns."""
    for batch in batches:
        if batch.num_rows:
            block, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            edges = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1), batch.num_rows]
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                yield (int(block[start]), int(kind[start])), batch.slice(start, stop - start)


def _many_queries(
    asked: DataFrame, rows: DataFrame, model: Model, scorer: CodeScorer, k: int, shortlist: int, exclude_same: bool,
) -> DataFrame:
    """Each query travels once, to the block of its cell's neighbourhood; a cell travels once to each block that looks into it.

    A block's task has its queries first and then reads the cells in portions, so its memory
    is bounded by the block, and only k matches of a query leave it.
    """
    shared, probes, cells, dimension = scorer.model, scorer.probes, len(model.centres), model.dimension
    slots = asked.sparkSession.sparkContext.defaultParallelism
    asked = asked.withColumn("mark", F.xxhash64("id"))

    def homes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        unit = unit_rows(batch.column(1))
        at = np.flatnonzero(~np.isnan(unit).any(axis=1))
        return at, unit[at], Model(*shared.value).cells_of(unit[at])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vector_search._portions(batches, -(-cells // 8)):
            count = np.bincount(homes(batch)[2], minlength=cells)
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at], pa.int64())], names=["cell", "n"])

    held = np.zeros(cells)
    for r in asked.mapInArrow(counted, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():  # at most the cells
        held[r[0]] = r[1]
    most = min(BLOCK_QUERIES, BLOCK_MATCHES // shortlist, BLOCK_LOOKS // cells)
    most = max(256, min(most, max(engine.SMALL_ROWS, int(held.sum()) // slots)))
    group = neighbourhoods(model.centres, held, most)
    parts = np.maximum(1, np.ceil(np.bincount(group, weights=held) / most)).astype(np.int64)  # a crowded cell is cut
    first, blocks = np.cumsum(parts) - parts, int(parts.sum())

    def blocks_of(batch: pa.RecordBatch, at: np.ndarray, home: np.ndarray) -> np.ndarray:
        own = group[home]
        return first[own] + batch.column(2).to_numpy()[at] % parts[own]

    def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vector_search._portions(batches, -(-cells // 8)):
            at, unit, home = homes(batch)
            looks, block = Model(*shared.value).nearest(unit, probes), blocks_of(batch, at, home)
            for b in np.unique(block):
                cell = np.flatnonzero(looks[block == b].any(axis=0))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), b), pa.int32()), pa.array(cell, pa.int32())], names=["block", "cell"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vector_search._portions(batches, -(-cells // 8)):
            at, _, home = homes(batch)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(blocks_of(batch, at, home), pa.int32()), taken.column(0), taken.column(1)], names=["block", "query_id", "query"])

    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("query_id", asked.schema[0].dataType), T.StructField("query", asked.schema[1].dataType)])
    routes = written(asked.mapInArrow(looked, "block int, cell int").distinct(), "index-routes")
    items = _of_cells(rows, routes).join(F.broadcast(routes), "cell").select("block", F.col("id").alias("item_id"), F.col("value").alias("item"), "code")
    sides = asked.mapInArrow(placed, schema).withColumn("kind", F.lit(0)).unionByName(items.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    columns = ("block", "kind", "query_id", "query", "item_id", "item", "code")
    together = sides.select(*columns).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")
    portion = max(1024, MEET_NUMBERS // dimension)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, waiting, lists = (-1, 0), [], None

        def met() -> None:
            nonlocal waiting, lists
            if waiting:
                table = pa.Table.from_batches(waiting)
                if here[1]:
                    lists.meet(*(engine._column(table, i) for i in (4, 5, 6)))
                else:
                    lists = Shortlists(*(engine._column(table, i) for i in (2, 3)), scorer, shortlist, exclude_same)
            waiting = []

        def best() -> Iterator[pa.RecordBatch]:
            nonlocal lists
            if lists is not None and lists.items is not None:
                yield lists.best(k)
            lists = None

        for at, part in _runs(batches):
            if at != here or (at[1] and sum(len(w) for w in waiting) >= portion):
                met()
                if at[0] != here[0]:
                    yield from best()
                here = at
            waiting.append(part)
        met()
        yield from best()

    return together.mapInArrow(search, engine.hits_schema(asked.schema[0], rows.schema["id"]))


def search_index(
    queries: DataFrame, path: str, k: int, probes: int | None = None, shortlist: int | None = None,
    query_id: str = "query_id", query_vector: str = "vector", exclude_same: bool = False,
) -> DataFrame:
    """The k nearest vectors of the index for every query: ``query_id, item_id, score, rank``.

    Scores are exact cosines; only which vectors are scored is approximate. ``probes``
    cells are looked into and ``shortlist`` vectors scored exactly, by default as many as
    the index has measured. Only the partitions of these cells are read. All cells and a
    shortlist as long as the corpus give the exact search.
    """
    spark = queries.sparkSession
    model = load_model(spark, path)
    return _search(queries, read_index(spark, path), model, k, probes or model.probes, shortlist or model.shortlist, query_id, query_vector, exclude_same)


def compared_share(queries: DataFrame, path: str, probes: int | None = None, query_vector: str = "vector") -> float:
    """The share of all (query, vector) pairs whose codes a search looks at."""
    spark = queries.sparkSession
    model = load_model(spark, path)
    asked = queries.select(F.lit(0).alias("id"), F.col(query_vector).alias("value")).where("value IS NOT NULL")
    shared, probes = _shared(spark, model), probes or model.probes

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vector_search._portions(batches, -(-len(shared.value[0]) // 8)):
            unit = unit_rows(batch.column(1))
            count = Model(*shared.value).nearest(vector_search._searchable(unit), probes).sum(axis=0)
            rows = np.zeros(len(count), np.int64)
            rows[0] = len(unit)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(count)), pa.int32()), pa.array(count, pa.int64()), pa.array(rows)], names=["cell", "n", "rows"])

    visited = written(asked.mapInArrow(visits, "cell int, n long, rows long").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")), "index-visits")
    sizes = read_index(spark, path).groupBy("cell").agg(F.count("*").alias("held"))
    pairs, total = visited.join(sizes, "cell").agg(F.sum(F.col("n") * F.col("held"))).head()[0], sizes.agg(F.sum("held")).head()[0]
    return (pairs or 0) / max(1, (total or 0) * (visited.agg(F.sum("rows")).head()[0] or 0))


def change_index(spark: SparkSession, path: str, changes: DataFrame, key: str = "chunk_id", vector: str = "vector") -> None:
    """Take over a change feed (as of :func:`gleanery.operators.sync.change_rows`) of ``key, change_type`` and the new vector.

    Deleted and updated keys leave their cell, inserted and updated vectors go to that of
    the model; each cell touched is rewritten whole, all others stay as they are. The same
    feed again changes nothing, so a failed call may be repeated. A feed holds a key once. A new vector that
    cannot be searched leaves the index. Cells are not learnt anew: build again when
    the corpus has changed at large.
    """
    model = load_model(spark, path)
    stored = spark.read.parquet(_rows_path(path))
    feed = written(changes.select(F.col(key).alias("id"), "change_type", F.col(vector).alias("value")).where("id IS NOT NULL"), "index-feed")
    added = written(_coded(feed.where("change_type <> 'delete' AND value IS NOT NULL").select("id", "value"), model), "index-added")
    old_cells = stored.select("cell", "id").join(feed.select("id"), "id", "left_semi").select("cell")
    touched = [r[0] for r in old_cells.union(added.select("cell")).distinct().collect()]  # at most the cells
    if not touched:
        return
    rest = sync.without_keys(stored.where(F.col("cell").isin(touched)), feed.select("id"), "id")
    empty = spark.createDataFrame([(c,) for c in touched], "cell int")  # keeps the partition of a cell that has lost all
    now = rest.where("id IS NOT NULL").unionByName(added).unionByName(empty, allowMissingColumns=True)
    _write_cells(now.select("cell", "id", "value", "code"), path, "overwrite")  # cells are replaced once all are written
