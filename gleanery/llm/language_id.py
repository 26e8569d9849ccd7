"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its byte n-grams, each hashed into one of
``BUCKETS`` rows; a linear layer and a softmax turn the mean into probabilities. Both
layers are trained together by stochastic gradient descent in numpy, on a bounded sample.
Scoring needs one table: embedding times weights, a few numbers for each bucket.

Rejection is calibrated on a part of the sample that took no part in training: a
temperature makes the probabilities honest, and two cuts, one on the highest
probability and one on the share of n-grams that training had met, are set so that
nearly all correctly recognised texts pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import regex

from gleanery.llm import common
from gleanery.session import written

UNDETERMINED = "und"
BUCKETS = 1 << 14
DIMENSION = 16
GRAMS = 1 << 22
ORDERS = (2, 3, 4)
#: Bytes looked at in one step; n-grams across a step's end are counted too.
STEP = 1 << 20


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # BUCKETS x langs, embedding times weights
    bias: np.ndarray
    met: np.ndarray  # GRAMS bits, 1 for n-grams of the training texts
    temperature: float = 1.0
    least_probability: float = 0.0
    least_seen: float = 0.0


def _fold_table() -> np.ndarray:
    """Bytes to symbols: ASCII other than letters is a gap, the rest stays."""
    symbols = np.arange(256, dtype=np.uint32)
    for b in range(128):
        if not chr(b).isalpha():
            symbols[b] = 32
    return symbols


def hashes(text: str) -> Iterator[np.ndarray]:
    """32-bit hashes of all n-grams of the whole text, step by step."""
    symbols = _fold_table()
    data = b" " + text.lower().encode("utf-8", "replace") + b" "
    for begin in range(0, max(1, len(data) - 1), STEP):
        a = symbols[np.frombuffer(data, np.uint8, min(STEP + max(ORDERS) - 1, len(data) - begin), begin)]
        last = begin + STEP >= len(data) - 1
        for n in ORDERS:
            if len(a) < n:
                continue
            h = np.full(len(a) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(n):
                h = h * np.uint32(0x01000193) ^ a[i : len(a) - n + 1 + i]
            h = h * np.uint32(0x85EBCA6B)
            yield h if last else h[:STEP]


def bucket(h: np.ndarray) -> np.ndarray:
    return h >> np.uint32(18)  # BUCKETS is 2 to the 14


def gram(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    return h >> np.uint32(10)  # GRAMS is 2 to the 22


def ngram_counts(text: str) -> np.ndarray:
    """How often each bucket is hit by the n-grams of the whole text."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for h in hashes(text):
        counts += np.bincount(bucket(h), minlength=BUCKETS)
    return counts


def is_met(met: np.ndarray, grams: np.ndarray) -> np.ndarray:
    return met[grams >> np.uint32(3)] >> (grams & np.uint32(7)).astype(np.uint8) & 1


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], met: np.ndarray, seed: int = 7, epochs: int = 8, rate: float = 8.0) -> Model:
    """Fit on (buckets, counts, lang) rows.

    ``rate`` is large because a gradient reaches an embedding only through its
    share in the mean, a few thousandths.
    """
    langs = sorted({lang for *_, lang in rows})
    index = {lang: i for i, lang in enumerate(langs)}
    rng = np.random.default_rng(seed)
    E = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    W = rng.normal(0, 0.1, (DIMENSION, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), dtype=np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 32):
            part = [rows[i] for i in order[at : at + 32]]
            x = _dense(part)
            mean = x @ E
            off = softmax(mean @ W + bias)
            off[np.arange(len(part)), [index[r[2]] for r in part]] -= 1
            off /= len(part)
            g_mean = off @ W.T
            W -= 0.5 * (mean.T @ off)
            bias -= 0.05 * off.sum(axis=0)
            E -= step * 10 * (x.T @ g_mean)
    return Model(langs, (E @ W).astype(np.float32), bias, met)


def _dense(part: list[tuple[np.ndarray, np.ndarray, str]]) -> np.ndarray:
    x = np.zeros((len(part), BUCKETS), dtype=np.float32)
    for i, (buckets, counts, _) in enumerate(part):
        x[i, buckets] = counts / max(1, counts.sum())
    return x


def calibrate(model: Model, rows: list[tuple[np.ndarray, np.ndarray, str]], known: np.ndarray, lost: float = 0.001) -> None:
    """Set the temperature by likelihood and the cuts so that a share ``lost`` of right answers fails.

    ``known`` is the share of met n-grams of each row. Languages that training had no
    row of do not count.
    """
    at = [i for i, r in enumerate(rows) if r[2] in model.langs]
    truth = np.array([model.langs.index(rows[i][2]) for i in at], dtype=int)
    if not at:
        return
    z = np.concatenate([_dense([rows[i] for i in at[j : j + 256]]) @ model.table for j in range(0, len(at), 256)]) + model.bias
    each = np.arange(len(truth))
    grid = [0.25 * 1.2**i for i in range(16)]
    model.temperature = min(grid, key=lambda t: -np.log(softmax(z / t)[each, truth] + 1e-9).mean())
    p = softmax(z / model.temperature)
    right = p.argmax(axis=1) == truth
    if right.any():
        model.least_probability = float(min(0.5, np.quantile(p.max(axis=1)[right], lost)))
        model.least_seen = float(np.quantile(known[at][right], lost))


def score_text(model: Model | None, text: str | None) -> tuple[str, float, bool]:
    """(language, probability, rejected) of a whole text; ``und`` without a letter or a model."""
    if model is None or text is None or not regex.search(r"\p{L}", text):
        return UNDETERMINED, 0.0, True
    counts, known = np.zeros(BUCKETS, dtype=np.int64), 0
    for h in hashes(text):
        counts += np.bincount(bucket(h), minlength=BUCKETS)
        known += int(is_met(model.met, gram(h)).sum())
    total = max(1, int(counts.sum()))
    p = softmax(((counts / total).astype(np.float32) @ model.table + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.langs[best], float(p[best]), bool(p[best] < model.least_probability or known / total < model.least_seen)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams and their counts of all parts."""
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([n for _, n in parts]))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, text in enumerate(common.strings_of(batch, "text")):
            c, parts = np.zeros(BUCKETS, dtype=np.int64), []
            for h in hashes(text or ""):
                c += np.bincount(bucket(h), minlength=BUCKETS)
                parts.append(np.unique(gram(h), return_counts=True))
                if len(parts) > 4 * len(ORDERS):
                    parts = [_summed(parts)]
            hit, (grams, times) = np.flatnonzero(c), _summed(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("mark").slice(i, 1), batch.column("lang").slice(i, 1),
                    pa.array([hit.astype("<u2").tobytes()], pa.binary()), pa.array([c[hit].astype("<f4").tobytes()], pa.binary()),
                    pa.array([grams.astype(np.int32)], pa.list_(pa.int32())), pa.array([times.astype("<f4").tobytes()], pa.binary()),
                ],
                names=["mark", "lang", "buckets", "counts", "grams", "times"],
            )


def _known_shares(met: np.ndarray):
    """Stage function: the share of met n-grams of each featurised row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = []
            for grams, times in zip(batch.column("grams"), batch.column("times"), strict=True):
                n = np.frombuffer(times.as_py(), "<f4").astype(float)
                shares.append(float(is_met(met, grams.values.to_numpy().astype(np.uint32)) @ n / max(1.0, n.sum())))
            yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(shares, pa.float64())], names=["mark", "share"])

    return run


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = 4000, seed: int = 7) -> Model | None:
    """Train on at most ``rows`` different rows with a language, chosen by a seeded hash; None without any.

    The executors turn whole texts into counts, which are written; a fifth of the rows
    calibrates. The driver gets the counts by bucket, at most 100 KB a row whatever the
    text's length, and which of the ``GRAMS`` bits are set, at most 16 MB. Null and empty
    texts teach nothing; bytes that are no UTF-8 count as U+FFFD.
    """
    some = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    some = common.bounded_sample(some.filter(F.col("lang").isNotNull() & (F.octet_length("text") > 0)), "id", rows, seed)
    kind = "mark bigint, lang string, buckets binary, counts binary, grams array<int>, times binary"
    features = written(some.select("mark", "lang", "text").mapInArrow(_featurise, kind), "language-sample")
    got = features.select("mark", "lang", "buckets", "counts").toArrow().sort_by("mark").to_pylist()
    if not got:
        return None
    held = {r["mark"] for r in got if r["mark"] % 5 == 4}
    apart = 0 < len(held) < len(got)  # else all rows do both
    aside = F.pmod("mark", F.lit(5)) == 4
    learn = features.filter(~aside) if apart else features
    met = np.zeros(GRAMS, dtype=bool)
    met[learn.select(F.explode("grams").alias("g")).distinct().toArrow().column("g").to_numpy()] = True
    met = np.packbits(met, bitorder="little")
    shares = (features.filter(aside) if apart else features).select("mark", "grams", "times")
    known = {r["mark"]: r["share"] for r in shares.mapInArrow(_known_shares(met), "mark bigint, share double").toArrow().to_pylist()}

    def plain(rows):
        return [(np.frombuffer(r["buckets"], "<u2"), np.frombuffer(r["counts"], "<f4"), r["lang"]) for r in rows]

    model = train(plain(r for r in got if not (apart and r["mark"] in held)), met, seed)
    tested = [r for r in got if r["mark"] in known]
    calibrate(model, plain(tested), np.array([known[r["mark"]] for r in tested]))
    return model


def predict(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every whole text: the id column, ``lang_pred``, ``score``, ``rejected``.

    One output row for each input row, repeated rows included; other columns are not
    looked at. A text that is null or has no letter is ``und`` with score 0 and is
    rejected; bytes that are no UTF-8 count as U+FFFD. Equal probabilities go to the language first by code point. One narrow
    pass; each batch of texts is scored where it lies.
    """
    def run(batches):
        for batch in batches:
            found = [score_text(model, t) for t in common.strings_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                names=["id", "lang_pred", "score", "rejected"],
            )

    kind = documents.schema[id_col].dataType.simpleString()
    plain = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)


def keep_recognised(documents: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows whose text is not rejected, with all their columns."""
    @F.pandas_udf("boolean")
    def passes(texts):
        return texts.map(lambda t: not score_text(model, None if t is None else bytes(t).decode("utf-8", "replace"))[2]).astype(bool)

    return documents.filter(passes(F.col(text_col).cast("binary")))
