"""Periodic runs of words, found with a dictionary of basic factors.

For each power of two every factor (stretch) of that many words gets a name, equal names
for equal factors, from the names of its two halves. Successive occurrences of a factor
that lie within half its length of each other form an arithmetic progression; progressions
and single occurrences within twice its length of each other propose periods. Each
proposal is extended to both sides with the names, longest factors first, and equal
stretches are kept once, with their smallest period.

Which occurrences to pair, for a factor of L words and a period q of L < q <= 2 L. Let a
run begin at s, so that the factor at s occurs at s + q too, in two different
progressions of step d. If the stretch of period d around s ends before the run's last q
words, it ends q words later around s + q, and the last members of both progressions are
q apart. Otherwise both stretches meet in fewer than d words around s + q, which is then
the first member of the second progression; every member of the first one that is
near enough begins a square that ends there. Work grows with the words, times the
logarithm of the longest repeat, and with the runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import texts_of

MIN_LENGTH = 12
BLOCK_WORDS = 1 << 16  # short texts are looked at together, up to so many words


class Factors:
    """The factors of one length that occur again: their places, by name and then place."""

    def __init__(self, n: int, at: np.ndarray, keys: np.ndarray):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        again = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(keys) else np.zeros(0, bool)
        first = np.concatenate([[True], ~same])[: len(keys)][again]
        self.places, self.names = at[order][again], np.cumsum(first) - 1
        self.n_names = int(first.sum())
        if 4 * len(self.places) >= n:
            self._dense = np.full(n, -1, np.int32)
            self._dense[self.places] = self.names
            self._at = np.flatnonzero(self._dense >= 0)
        else:
            back = np.argsort(self.places)
            self._dense, self._at, self._names = None, self.places[back], self.names[back].astype(np.int32)
        self._n = n

    @property
    def at(self) -> np.ndarray:
        """Their places in ascending order."""
        return self._at

    def name(self, places: np.ndarray) -> np.ndarray:
        """Names at these places; -1 where the factor occurs nowhere else or leaves the words."""
        if self._dense is not None:
            inside = (places >= 0) & (places < self._n)
            return np.where(inside, self._dense[np.where(inside, places, 0)], -1)
        if not len(self._at):
            return np.full(len(places), -1, np.int32)
        i = np.minimum(np.searchsorted(self._at, places), len(self._at) - 1)
        return np.where(self._at[i] == places, self._names[i], -1)


def dictionary(words: np.ndarray) -> list[Factors]:
    """Factors of 1, 2, 4, ... words, up to the longest that occurs twice. -1 equals nothing."""
    n = len(words)
    at = np.flatnonzero(words >= 0)
    levels = [Factors(n, at, words[at])]
    while len(levels[-1].places):
        last, length = levels[-1], 1 << (len(levels) - 1)
        left, right = last.name(last.at), last.name(last.at + length)
        whole = right >= 0
        levels.append(Factors(n, last.at[whole], left[whole].astype(np.int64) * last.n_names + right[whole]))
    return levels[:-1]


def proposed(factors: Factors, length: int, lowest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that occurrences of factors of this length propose.

    Periods are above ``length`` and at most twice it; at the lowest level also smaller.
    """
    places, names = factors.places, factors.names
    near = (names[1:] == names[:-1]) & (np.diff(places) <= length // 2)
    starts = np.flatnonzero(np.concatenate([[True], ~near]))
    count = np.diff(np.concatenate([starts, [len(places)]]))
    first, last, name = places[starts], places[starts + count - 1], names[starts]
    step = (last - first) // np.maximum(count - 1, 1)
    out = [(first[step > 0], step[step > 0])] if lowest else []
    for apart in (1, 2, 3):  # progressions begin over half a length apart, so no fourth one is near
        c = np.flatnonzero((name[apart:] == name[:-apart]) & (first[apart:] - last[:-apart] <= 2 * length))
        out.append((last[c], last[c + apart] - last[c]))
        wide = np.maximum(step[c], step[c + apart])
        c, wide = (x[(wide > 0) & (first[c + apart] <= last[c] + length + 2 * wide)] for x in (c, wide))
        least = first[c + apart] - last[c]
        most = np.minimum(2 * length, last[c + apart] + length + wide - first[c + apart])
        members = np.where(least <= most, np.minimum(count[c], (most - least) // np.maximum(step[c], 1) + 1), 0)
        of = np.repeat(np.arange(len(c)), members)
        back = (np.arange(len(of)) - np.repeat(np.cumsum(members) - members, members)) * step[c][of]
        out.append((last[c][of] - back, least[of] + back))
    place, period = (np.concatenate(x) for x in zip(*out, strict=True))
    fits = (period <= 2 * length) & (period > (0 if lowest else length))
    return place[fits], period[fits]


def extended(levels: list[Factors], place: np.ndarray, period: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches around the proposals in which words ``period`` apart are equal."""
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    # proposals of one period whose factors touch lie in one stretch
    new = np.concatenate([[True], (period[1:] != period[:-1]) | (np.diff(place) > length)])[: len(place)]
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(place)]]) - 1
    begin, end, period = place[heads], place[tails] + length, period[heads]
    for k in range(len(levels) - 1, -1, -1):
        name = levels[k].name
        ahead = name(end)
        end = end + ((ahead >= 0) & (ahead == name(end + period))) * (1 << k)
        behind = name(begin - (1 << k))
        begin = begin - ((behind >= 0) & (behind == name(begin - (1 << k) + period))) * (1 << k)
    return np.stack([begin, end + period]), period


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows of start, length and smallest period of all runs, by start and then period.

    ``words`` are numbers, equal for equal words; -1 equals nothing, itself included. A run
    is a stretch of at least ``min_length`` words and two periods that cannot be extended.
    """
    if min_length < 2:
        raise ValueError("a run has at least two words")
    levels = dictionary(np.asarray(words, np.int64))
    lowest = (min_length // 2).bit_length() - 1
    found = [np.zeros((3, 0), np.int64)]
    for k in range(lowest, len(levels)):
        place, period = proposed(levels[k], 1 << k, k == lowest)
        if len(place):
            span, period = extended(levels, place, period, 1 << k)
            length = span[1] - span[0]
            whole = length >= np.maximum(min_length, 2 * period)
            found.append(np.stack([span[0], length, period])[:, whole])
    runs = np.concatenate(found, axis=1).T
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    once = np.ones(len(runs), bool)  # a stretch is also found with multiples of its period
    once[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[once]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def repeated(runs: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` words, whether a run has it after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def runs_of_texts(texts: list[list[bytes]], min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all texts at once: number of the text, run, and for each word whether it repeats.

    Words of different texts get different numbers and a gap stands between texts, so no
    factor occurs in two of them.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    number: dict[bytes, int] = {}
    for t in texts:
        number.update(dict.fromkeys(t, 0))
    number = {w: i for i, w in enumerate(number)}
    line = np.full(int((sizes + 1).sum()), -1, np.int64)
    for i, (t, begin) in enumerate(zip(texts, begins.tolist(), strict=True)):
        if t:
            line[begin : begin + len(t)] = np.fromiter(map(number.__getitem__, t), np.int64, len(t)) + i * len(number)
    runs = find_runs(line, min_length)
    again = repeated(runs, len(line))
    of = np.searchsorted(begins, runs[:, 0], side="right") - 1
    runs = runs - np.stack([begins[of], 0 * of, 0 * of], axis=1)
    return of, runs, again[line >= 0]


def periodic_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """The id column, ``n_words``, ``runs`` (start, length, period) and ``collapsed`` for each row.

    Words are what lies between spaces and U+0009 to U+000D. ``collapsed`` holds the words
    that no run has after its first period, joined by spaces. ``rewrite(id, words)`` may
    change the words first. Null and empty texts have no words, no runs and an empty
    ``collapsed``; bytes that are no UTF-8 are words like any other. Rows do not affect
    each other, so repeated ids are no matter, and no column but the two named is looked at.

    One narrow pass. A task holds one text, or some short ones, with its names: up to eight
    bytes a word and level, of which there are as many as the longest repeat has doublings.
    """
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, block, held, begin = batch.column("id"), [], 0, 0
            for i, text in enumerate(texts_of(batch)):
                words = (text or b"").split()
                block.append(rewrite(ids[i].as_py(), words) if rewrite else words)
                held += len(block[-1])
                if held >= BLOCK_WORDS or i == batch.num_rows - 1:
                    yield _result(ids.slice(begin, len(block)), block, min_length)
                    block, held, begin = [], 0, i + 1

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary")
    return out.select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def _result(ids: pa.Array, texts: list[list[bytes]], min_length: int) -> pa.RecordBatch:
    of, runs, again = runs_of_texts(texts, min_length)
    offsets = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, j])) for j in range(3)], names=["start", "length", "period"])
    kept, at = [], 0
    for words in texts:
        drop = again[at : at + len(words)]
        at += len(words)
        kept.append(b" ".join([w for w, d in zip(words, drop.tolist(), strict=True) if not d] if drop.any() else words))
    return pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), spans), pa.array(kept, pa.binary())], names=["id", "n_words", "runs", "collapsed"])
