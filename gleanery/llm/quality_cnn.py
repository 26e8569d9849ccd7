"""Quality classifier: a byte-level convolutional network in numpy.

Each byte has a learned embedding. Filters of ``WIDTH`` bytes move over the text in steps
of ``STRIDE`` bytes; their rectified outputs are max-pooled within chunks that overlap by
half. A text is the mean, maximum and minimum of its chunks, and a logistic layer turns
these into one probability; the minimum shows stretches in which little varies. Chunks cover the whole text, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import common

EMBEDDING = 8
WIDTH = 8
STRIDE = 4
FILTERS = 24
HALF = 32  # windows in half a chunk; a chunk spans 2 * HALF * STRIDE bytes
#: Texts longer than this are passed over when sampling for training only.
MOST_TRAINING_BYTES = 60_000
#: Bytes convolved at once; a multiple of HALF * STRIDE, so that chunks do not depend on it.
STEP = HALF * STRIDE * 4096


@dataclass
class Network:
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: np.ndarray  # WIDTH * EMBEDDING x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # of each filter's mean, maximum and minimum over chunks
    offset: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.weights, self.offset]


def fresh(seed: int) -> Network:
    rng = np.random.default_rng(seed)
    return Network(
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        rng.normal(0, 1 / np.sqrt(WIDTH * EMBEDDING), (WIDTH * EMBEDDING, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32), np.zeros(1, np.float32),
    )


def padded(data: bytes) -> np.ndarray:
    """Bytes, zero-filled to whole strides and at least one window."""
    size = max(WIDTH, -(-len(data) // STRIDE) * STRIDE)
    return np.frombuffer(data.ljust(size, b"\0"), np.uint8)


def convolved(net: Network, codes: np.ndarray) -> np.ndarray:
    """Rectified outputs, one row for each window."""
    x = net.embedding[codes].reshape(-1, STRIDE * EMBEDDING)  # a row for each stride
    n = len(x) - WIDTH // STRIDE + 1
    out = np.tile(net.bias, (n, 1))
    for i in range(WIDTH // STRIDE):
        out += x[i : n + i] @ net.filters[i * STRIDE * EMBEDDING : (i + 1) * STRIDE * EMBEDDING]
    return np.maximum(out, 0, out=out)


def halves(y: np.ndarray) -> np.ndarray:
    """Maxima within half chunks; the last may be short."""
    return np.maximum.reduceat(y, np.arange(0, len(y), HALF), axis=0)


def chunk_pools(h: np.ndarray) -> np.ndarray:
    """Each chunk is two neighbouring halves; a text of one half is one chunk."""
    return np.maximum(h[:-1], h[1:]) if len(h) > 1 else h


def probability(net: Network, data: bytes | None) -> float:
    """Score of a whole text, between 0 and 1; null counts as empty."""
    codes, found = padded(data or b""), []
    for at in range(0, len(codes) - WIDTH + STRIDE, STEP):
        found.append(halves(convolved(net, codes[at : at + STEP + WIDTH - STRIDE])))
    pools = chunk_pools(np.concatenate(found))
    z = float(np.concatenate([pools.mean(axis=0), pools.max(axis=0), pools.min(axis=0)]) @ net.weights + net.offset[0])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def gradients(net: Network, data: bytes, label: int) -> tuple[list[np.ndarray], float]:
    """Of the log loss on one text, by each part of the network; and the loss."""
    codes = padded(data)
    y = convolved(net, codes)
    starts = np.arange(0, len(y), HALF)
    h = np.maximum.reduceat(y, starts, axis=0)
    pools = chunk_pools(h)
    each = np.arange(FILTERS)
    top, low = pools.argmax(axis=0), pools.argmin(axis=0)
    features = np.concatenate([pools.mean(axis=0), pools[top, each], pools[low, each]])
    p = 1 / (1 + np.exp(-np.clip(features @ net.weights + net.offset[0], -30, 30)))
    off = float(p - label)
    g_features = off * net.weights
    g_pools = np.repeat(g_features[None, :FILTERS] / len(pools), len(pools), axis=0)
    g_pools[top, each] += g_features[FILTERS : 2 * FILTERS]
    g_pools[low, each] += g_features[2 * FILTERS :]
    if len(h) > 1:  # to the larger half
        first = h[:-1] >= h[1:]
        g_h = np.zeros_like(h)
        g_h[:-1] += g_pools * first
        g_h[1:] += g_pools * ~first
    else:
        g_h = g_pools
    # to the first window of each half that reaches the maximum
    full = np.full((len(h) * HALF, FILTERS), -1, np.float32)
    full[: len(y)] = y
    rows = full.reshape(len(h), HALF, FILTERS).argmax(axis=1) + starts[:, None]
    g_h = g_h * (h > 0)
    rows, cols, g = rows.ravel(), np.tile(np.arange(FILTERS), len(h)), g_h.ravel()
    live = g != 0
    rows, cols, g = rows[live], cols[live], g[live]
    windows = codes[rows[:, None] * STRIDE + np.arange(WIDTH)]  # the bytes below each maximum
    x = net.embedding[windows].reshape(len(rows), -1)
    g_filters = np.zeros_like(net.filters)
    np.add.at(g_filters.T, cols, g[:, None] * x)
    g_x = (g[:, None] * net.filters.T[cols]).reshape(-1, EMBEDDING)
    g_embedding = np.stack([np.bincount(windows.ravel(), g_x[:, e], 256) for e in range(EMBEDDING)], axis=1)
    g_bias = np.bincount(cols, g, FILTERS)
    loss = -np.log(max(1e-9, p if label else 1 - p))
    return [g_embedding, g_filters, g_bias, off * features, np.array([off])], float(loss)


def train(rows: list[tuple[bytes, int]], seed: int = 5, epochs: int = 5, rate: float = 0.004, batch: int = 16) -> Network:
    """Adam over minibatches; a constant network of probability 0.5 without rows of both labels."""
    net = fresh(seed)
    if len({label for _, label in rows}) < 2:
        net.weights[:] = 0
        if rows:
            net.offset[:] = 3 if rows[0][1] else -3
        return net
    rng = np.random.default_rng(seed)
    share = [max(1, sum(label == k for _, label in rows)) / len(rows) for k in (0, 1)]
    first = [np.zeros(p.shape) for p in net.parts()]
    second = [np.zeros(p.shape) for p in net.parts()]
    t, steps = 0, epochs * -(-len(rows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            total = [np.zeros(p.shape) for p in net.parts()]
            for i in order[at : at + batch]:
                g, _ = gradients(net, *rows[i])
                weight = (0.5 / share[rows[i][1]]) ** 0.5  # between the true and equal shares
                for a, b in zip(total, g, strict=True):
                    a += weight * b / batch
            t += 1
            step = rate * (1 - (t - 1) / steps)
            for p, g, m, v in zip(net.parts(), total, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = 2500, seed: int = 5, most_bytes: int = MOST_TRAINING_BYTES) -> Network:
    """Train on at most ``rows`` labelled rows outside of the held-out fold.

    The rows are chosen by a seeded hash; texts of more than ``most_bytes`` are not trained
    on, which bounds what the driver gets. Equal rows count once. A null label, id or text
    teaches nothing.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isin(0, 1) & ~common.held_out(F.col("id")))
    some = common.bounded_sample(marked, "id", rows, seed).drop("mark")
    plain = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("data"))
    found = common.bounded_sample(plain.join(F.broadcast(some), "id").filter(F.octet_length("data") <= most_bytes), "id", rows, seed)
    got = sorted((r["id"], r["label"], bytes(r["data"])) for r in found.collect())
    return train([(data, label) for _, label, data in got], seed)


def score(documents: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and ``score`` of every whole text, one row for each input row.

    Null and empty texts get the score of an empty text. Other columns are not looked
    at. One narrow pass; a text is convolved in steps, so memory does not grow with it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [probability(net, t) for t in common.texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.float64())], names=["id", "score"])

    kind = documents.schema[id_col].dataType.simpleString()
    plain = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
