"""SimHash near-duplicates with pivot distance tables.

Every different fingerprint gets a table row: its Hamming distances to ``PIVOTS`` fixed
reference fingerprints. Distances to a pivot differ by no more than the fingerprints do
(triangle inequality), so a pair with a coordinate difference above the limit is
discarded unseen; survivors are verified bit by bit.

A table alone would still have all pairs to look at. Which pairs meet is settled first:
fingerprints that differ in at most ``limit`` bits agree on at least one of ``limit + 1``
bit ranges, so only those with an equal range are put together. A range that too many
share is cut again in the same way among its other bits, and a group that still is too
large (a thick cluster) is compared block against block. Nothing is dropped.

Within a group only the links of a spanning forest are emitted, never all pairs. Exact
copies are one fingerprint from the start. Components are found by rounds that hook
each node to the least node around it; all state is in tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
import xxhash

from gleanery.llm import common
from gleanery.session import written

SHINGLE = 4
LIMIT = 4
PIVOTS = 16
#: Fingerprints in one group before it is cut again, and in one block of a thick cluster.
MOST_IN_GROUP = 4096


def fingerprint(data: bytes | None, width: int = SHINGLE) -> int:
    """64 bits, unsigned; 0 without words."""
    words = (data or b"").lower().split()  # bytes.lower() changes A to Z only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    joined = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(first[at : at + (1 << 14)], last[at : at + (1 << 14)], strict=False)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [signed(fingerprint(t)) for t in common.texts_of(b)]
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.int64())], names=["id", "fp"])


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp``, the fingerprint as a signed long, of every whole text."""
    kind = documents.schema[id_col].dataType.simpleString()
    plain = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(_fingerprints, f"id {kind}, fp bigint")


def pivots(count: int = PIVOTS, seed: int = 64) -> list[int]:
    """Reference fingerprints: seeded, so that half of the bits of any two differ."""
    return [signed(int(x)) for x in np.random.default_rng(seed).integers(0, 1 << 64, count, dtype=np.uint64)]


def pivot_table(different: DataFrame, count: int = PIVOTS) -> DataFrame:
    """Adds ``near``: distances to the pivots, a byte each, eight in a long."""
    longs = []
    for at in range(0, count, 8):
        packed = F.lit(0).cast("bigint")
        for i, p in enumerate(pivots(count)[at : at + 8]):
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("bigint"), 8 * i))
        longs.append(packed)
    return different.withColumn("near", F.array(*longs))


def bit_ranges(bits: list[int], parts: int) -> list[list[int]]:
    """Bits cut into ``parts`` ranges of nearly equal length."""
    edges = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def mask(bits: list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def grouped(table: DataFrame, limit: int, most: int) -> DataFrame:
    """Each fingerprint in every group in which it could meet a neighbour.

    Columns ``group`` (string), ``left``, ``right`` and those of the table. A row is in the
    first side, the second side or both of a comparison.
    """
    everything = list(range(64))
    first = bit_ranges(everything, limit + 1)
    keys = F.array(*[F.struct(F.lit(i).alias("range"), F.col("fp").bitwiseAND(F.lit(mask(r))).alias("value")) for i, r in enumerate(first)])
    keyed = table.select("fp", "near", F.explode(keys).alias("key")).select("fp", "near", "key.range", "key.value")
    sizes = table.select(F.explode(keys).alias("key")).groupBy("key.range", "key.value").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = written(sizes, "simhash-sizes")
    placed = keyed.join(sizes, ["range", "value"])
    small = placed.filter(F.col("n") <= most).select(F.concat_ws(":", "range", "value").alias("group"), F.lit(True).alias("left"), F.lit(True).alias("right"), "fp", "near")
    if not sizes.filter(F.col("n") > most).limit(1).count():
        return small
    # cut crowded ranges again, among the bits outside of them
    again = []
    for i, r in enumerate(first):
        rest = [b for b in everything if b not in r]
        again.append(F.array(*[F.struct(F.lit(j).alias("range"), F.col("fp").bitwiseAND(F.lit(mask(s))).alias("value")) for j, s in enumerate(bit_ranges(rest, limit + 1))]))
    inner = F.element_at(F.array(*again), F.col("range") + 1)
    crowded = placed.filter(F.col("n") > most).select("fp", "near", F.concat_ws(":", "range", "value").alias("outer"), F.explode(inner).alias("sub"))
    crowded = crowded.select("fp", "near", F.concat_ws(":", "outer", "sub.range", "sub.value").alias("group"))
    crowded = written(crowded, "simhash-crowded")
    counts = written(crowded.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-crowded-sizes")
    cut = crowded.join(counts, "group")
    # a thick cluster: every block meets itself and each later block
    blocks = F.ceil(F.col("n") / most).cast("int")
    cut = cut.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("own"), o).alias("a"), F.greatest(F.col("own"), o).alias("b")))
    met = cut.withColumn("meet", F.explode(meets))
    large = met.select(
        F.concat_ws(":", "group", "meet.a", "meet.b").alias("group"), (F.col("own") == F.col("meet.a")).alias("left"), (F.col("own") == F.col("meet.b")).alias("right"), "fp", "near"
    )
    return small.unionByName(large)


def near_pairs(fp: np.ndarray, near: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``limit`` bits, as two arrays of places.

    Breadth first: each place taken up looks only at places not reached yet. Those are
    kept in order of the first pivot's distance, so most are passed over by bisection;
    the others are discarded by the largest coordinate difference, then verified.
    """
    order = np.argsort(near[:, 0], kind="stable")
    f, t = fp[order], near[order].astype(np.int16)
    open_ = np.arange(len(f))
    src: list[int] = []
    dst: list[int] = []
    queue: list[int] = []
    while len(open_) > 1 or (queue and len(open_)):
        if not queue:
            queue.append(int(open_[0]))
            open_ = open_[1:]
        v = queue.pop()
        coordinate = t[open_, 0]
        lo, hi = np.searchsorted(coordinate, (t[v, 0] - limit, t[v, 0] + limit + 1))
        if lo == hi:
            continue
        some = open_[lo:hi]
        fits = np.abs(t[some] - t[v]).max(axis=1) <= limit
        fits[fits] = np.bitwise_count(f[some[fits]] ^ f[v]) <= limit
        if fits.any():
            found = some[fits]
            src += [v] * len(found)
            dst += found.tolist()
            queue += found.tolist()
            open_ = np.concatenate([open_[:lo], some[~fits], open_[hi:]])
    return order[np.array(src, int)], order[np.array(dst, int)]


def small_pairs(fp: np.ndarray, near: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within ``limit`` bits of a handful of fingerprints."""
    t = near.astype(np.int16)
    a, b = np.triu_indices(len(fp), 1)
    fits = np.abs(t[a, 0] - t[b, 0]) <= limit
    a, b = a[fits], b[fits]
    fits = np.abs(t[a] - t[b]).max(axis=1, initial=0) <= limit
    a, b = a[fits], b[fits]
    fits = np.bitwise_count(fp[a] ^ fp[b]) <= limit
    return a[fits], b[fits]


def crossing_pairs(fp: np.ndarray, near: np.ndarray, left: np.ndarray, right: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Between two blocks: for each place on the left its links to the right that join parts not joined yet."""
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    t = near.astype(np.int16)
    parent = np.arange(len(fp))
    src, dst = [], []
    for v in a:
        fits = np.abs(t[b] - t[v]).max(axis=1) <= limit
        fits[fits] = np.bitwise_count(fp[b[fits]] ^ fp[v]) <= limit
        for w in b[fits]:
            x, y = v, w
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            while parent[y] != y:
                parent[y] = parent[parent[y]]
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)
                src.append(v)
                dst.append(w)
    return np.array(src, int), np.array(dst, int)


def _links(limit: int):
    def compare(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        fp, near, left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
        if len(fp) < 2:
            return fp[:0], fp[:0]
        if not (left & right).all():
            a, b = crossing_pairs(fp, near, left, right, limit)
        else:
            a, b = (small_pairs if len(fp) <= 48 else near_pairs)(fp, near, limit)
        return fp[a], fp[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None
        out_a: list[np.ndarray] = []
        out_b: list[np.ndarray] = []

        def flush():
            a, b = np.concatenate(out_a or [np.zeros(0, np.uint64)]), np.concatenate(out_b or [np.zeros(0, np.uint64)])
            out_a.clear()
            out_b.clear()
            low, high = np.minimum(a.view(np.int64), b.view(np.int64)), np.maximum(a.view(np.int64), b.view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])

        for batch in batches:
            groups = batch.column("group")
            codes = groups.dictionary_encode()
            index = codes.indices.to_numpy()
            edges = np.flatnonzero(np.diff(index)) + 1
            fp = batch.column("fp").to_numpy().view(np.uint64)
            near = batch.column("near").flatten().to_numpy().reshape(len(fp), -1).copy().view(np.uint8)
            left, right = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
            for lo, hi in zip([0, *edges], [*edges, len(fp)], strict=True):
                if lo == hi:
                    continue
                own = codes.dictionary[int(index[lo])].as_py()
                if held and own != name:
                    a, b = compare(held)
                    out_a.append(a)
                    out_b.append(b)
                    held = []
                name = own
                held.append((fp[lo:hi], near[lo:hi], left[lo:hi], right[lo:hi]))
            yield flush()
        if held:
            a, b = compare(held)
            out_a.append(a)
            out_b.append(b)
            yield flush()

    return run


def links(different: DataFrame, limit: int = LIMIT, most: int = MOST_IN_GROUP) -> DataFrame:
    """Pairs ``a`` < ``b`` of different fingerprints within ``limit`` bits that connect all there are."""
    table = written(pivot_table(different.select("fp")), "simhash-pivots")
    groups = grouped(table, limit, most).repartition("group").sortWithinPartitions("group")
    return groups.mapInArrow(_links(limit), "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, of all nodes that have a link.

    Each round points both ends of every link at the least root around them, then follows
    roots to their own roots, until no root changes. Edges between nodes of one root leave.
    """
    edges = written(edges, "simhash-links")
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    roots = written(both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("root")), "simhash-roots")
    while True:
        # links between roots
        of = lambda n: roots.select(F.col("node").alias(n), F.col("root").alias(f"r{n}"))
        between = edges.join(of("a"), "a").select("b", "ra").join(of("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        # and from each root to the root that it points at itself
        own = roots.join(roots.select(F.col("node").alias("root"), F.col("root").alias("up")), "root").select(F.col("root").alias("a"), F.col("up").alias("b"))
        left = between.union(own).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        left = written(left, "simhash-links")
        if not left.limit(1).count():
            return roots
        hook = left.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to"))
        roots = written(roots.join(written(hook, "simhash-hooks"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "simhash-roots")
        edges = left


def classes(prints: DataFrame, limit: int = LIMIT, most: int = MOST_IN_GROUP) -> DataFrame:
    """``fp`` and ``component_id``, the smallest id in its component, for each different fingerprint."""
    ids = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-different")
    roots = components(links(ids, limit, most))
    rooted = written(ids.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return written(rooted.join(written(least, "simhash-least"), "root").select("fp", "component_id"), "simhash-classes")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, most: int = MOST_IN_GROUP) -> DataFrame:
    """The id, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    Null, empty and blank texts have fingerprint zero and link like any other. Repeated
    rows each get theirs. Null ids are passed over in minima; a component of null ids only
    has a null id. Other columns are not looked at.
    """
    prints = written(fingerprints(documents, id_col, text_col), "simhash-prints")
    found = prints.join(classes(prints, limit, most), "fp")
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_first(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, most: int = MOST_IN_GROUP) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id.

    Rows equal in id and text are one. Where an id stands for several different texts, it
    stays once for each text. Rows with a null id take no part and stay.
    """
    prints = written(fingerprints(documents, id_col, text_col), "simhash-prints")
    winners = written(classes(prints.filter("id is not null"), limit, most).select(F.col("component_id").alias("winner")).distinct(), "simhash-winners")
    inner = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kept = inner.join(winners, F.col("id") == F.col("winner"), "left_semi").dropDuplicates(["id", "text"])
    return kept.unionByName(inner.filter("id is null")).select("row.*")
