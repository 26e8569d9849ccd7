"""Quality rules: a decision list learnt from labelled text statistics.

Sequential covering: grow a conjunction of threshold tests that separates low-quality
texts from the rest by information gain, prune it on rows it was not grown on, set
aside what it covers, and go on until no rule is precise enough. The list is emitted as
an ordered Spark conditional expression over the statistics; it can be printed and read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm import common
from gleanery.session import written

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: What thresholds are set on: a ratio of two counts, each per word or per character.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "repeats_per_word": ("n_repeat_words", "n_words"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
}

_KEPT_BYTES = np.ones(256, dtype=np.uint8)
_KEPT_BYTES[0x80:0xC0] = 0  # continuation bytes: a code point counts at its first byte
_KEPT_BYTES[[0x20, *range(0x09, 0x0E)]] = 0
_UPPER = np.zeros(256, dtype=np.uint8)
_UPPER[65:91] = 1  # A to Z
_MARKS = re.compile(rb"[!?]+")


def repeated_words(words: Sequence[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur at least twice, the first one included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    key = ids[:n]
    for i in range(1, width):  # renumbered at each step, so that keys never overflow
        pair = key * len(number) + ids[i : n + i]
        key = np.unique(pair, return_inverse=True)[1] if i < width - 1 else pair
    _, back, often = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(often[back] > 1)
    covered = np.zeros(len(words), dtype=bool)
    for i in range(width):
        covered[starts + i] = True
    return int(covered.sum())


def text_counts(data: bytes | None) -> tuple[int, ...]:
    """The COUNTS of one whole text; all 0 for null and empty texts."""
    if not data:
        return (0,) * len(COUNTS)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.split()]
    at = np.frombuffer(data, np.uint8)
    return (
        len(words), int(np.count_nonzero(_KEPT_BYTES[at])), sum(data.count(s.encode()) for s in SYMBOLS),
        len(lines) - len(set(lines)), repeated_words(words), int(np.count_nonzero(_UPPER[at])), len(_MARKS.findall(data)),
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([text_counts(t) for t in common.texts_of(batch)], dtype=np.int64).reshape(-1, len(COUNTS))
        kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*kept, *(pa.array(found[:, i]) for i in range(len(COUNTS)))], names=[*names, *COUNTS])


def statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and the COUNTS of every whole text; null and empty texts count 0.

    One row for each input row. Other columns are not looked at.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    plain = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(_count_batches, f"id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS)).withColumnRenamed("id", id_col)


@dataclass(frozen=True)
class Test:
    """``ratio`` compared with ``cut``: above it, or at most it."""

    ratio: str
    above: bool
    cut: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        v = values[:, list(RATIOS).index(self.ratio)]
        return v > self.cut if self.above else v <= self.cut

    def column(self) -> Column:
        top, bottom = RATIOS[self.ratio]
        v = F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))
        return v > F.lit(self.cut) if self.above else v <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.ratio} {'>' if self.above else '<='} {self.cut:g}"


Rule = tuple[Test, ...]


def ratios(counts: np.ndarray) -> np.ndarray:
    at = {c: counts[:, i].astype(np.float64) for i, c in enumerate(COUNTS)}
    return np.stack([np.divide(at[a], at[b], out=np.zeros(len(counts)), where=at[b] > 0) for a, b in RATIOS.values()], axis=1)


def covers(rule: Rule, values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), dtype=bool)
    for t in rule:
        out &= t.holds(values)
    return out


def _grow(values: np.ndarray, bad: np.ndarray, longest: int) -> Rule:
    """Add the test of most information gain until no good text is covered or none gains."""
    rule: Rule = ()
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < longest and (~bad[inside]).any() and bad[inside].any():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        base, best = log2(p0 / (p0 + n0)), (1e-9, None)
        for j, name in enumerate(RATIOS):
            v = values[inside, j]
            order = np.argsort(v, kind="stable")
            v, b = v[order], bad[inside][order]
            ends = np.flatnonzero(v[1:] > v[:-1])  # cuts lie between different values
            low_p, low_n = np.cumsum(b)[ends], np.cumsum(~b)[ends]
            for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), 0)
                if len(gain) and gain.max() > best[0]:
                    k = int(gain.argmax())
                    best = (float(gain[k]), Test(name, above, float((v[ends[k]] + v[ends[k] + 1]) / 2)))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= best[1].holds(values)
    return rule


def _worth(rule: Rule, values: np.ndarray, bad: np.ndarray) -> float:
    inside = covers(rule, values)
    p, n = bad[inside].sum(), (~bad[inside]).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn(counts: np.ndarray, bad: np.ndarray, seed: int = 11, longest: int = 4, most_rules: int = 12, precision: float = 0.98, least: int = 5) -> list[Rule]:
    """The ordered rules for low quality.

    Two thirds of the rows grow a rule, one third prunes it: its last tests are dropped
    while that is no worse there. A rule must cover ``least`` low-quality rows and be right
    in ``precision`` of all rows it covers; the first that is not ends the list.
    """
    values, bad = ratios(counts), bad.astype(bool)
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    while len(rules) < most_rules and bad.any() and (~bad).any():
        order = rng.permutation(len(bad))
        grow, prune = order[: len(order) * 2 // 3], order[len(order) * 2 // 3 :]
        rule = _grow(values[grow], bad[grow], longest)
        if not rule:
            break
        options = [rule[:k] for k in range(1, len(rule) + 1)]
        rule = max(options, key=lambda r: (_worth(r, values[prune], bad[prune]), -len(r)))
        inside = covers(rule, values)
        if bad[inside].sum() < least or bad[inside].mean() < precision:
            rule = options[-1]  # unpruned, before giving up
            inside = covers(rule, values)
            if bad[inside].sum() < least or bad[inside].mean() < precision:
                break
        rules.append(rule)
        values, bad = values[~inside], bad[~inside]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one expression: the first rule that holds rejects, else the text is kept."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for t in rule[1:]:
            test &= t.column()
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = 8000, seed: int = 11) -> list[Rule]:
    """Learn from at most ``rows`` labelled rows outside of the held-out fold.

    The labels are chosen by a seeded hash, and that many are small enough to send to the
    documents. Texts are counted where they lie; the counts are written, and the driver
    gets at most four different rows of them for each label. A null label or id teaches
    nothing; an id labelled twice counts once for each label.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good")).filter(F.col("good").isNotNull() & ~common.held_out(F.col("id")))
    some = common.bounded_sample(marked, "id", rows, seed).drop("mark")
    plain = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = plain.join(F.broadcast(some), "id").select(F.xxhash64("id").alias("id"), "good", "text")
    counted = joined.mapInArrow(_count_batches, "id bigint, good int, " + ", ".join(f"{c} bigint" for c in COUNTS))
    found = common.bounded_sample(written(counted, "rule-sample"), "id", 4 * rows, seed).select("good", *COUNTS)
    got = np.array(sorted(tuple(r) for r in found.collect()), dtype=np.int64).reshape(-1, 1 + len(COUNTS))
    usable = got[(got[:, 1] >= MIN_WORDS) & (100 * got[:, 5] <= MAX_REPEAT_PERCENT * got[:, 1])]  # the base rules see to the rest
    return learn(usable[:, 1:], usable[:, 0] == 0, seed)


def judge(documents: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every text.

    A text fails the base for under 50 words or over half of its words repeated; null and
    empty texts fail it. Otherwise the decision list has the word. One narrow pass.
    """
    out = statistics(documents, id_col, text_col).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(documents: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows that ``judge`` keeps, with all their columns."""
    kind = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"

    @F.pandas_udf(kind)
    def counted(texts):
        import pandas as pd

        return pd.DataFrame([text_counts(None if t is None else bytes(t)) for t in texts], columns=list(COUNTS))

    names = documents.columns
    inner = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), counted(F.col(text_col).cast("binary")).alias("counts"))
    flat = inner.select("row", *[F.col(f"counts.{c}").alias(c) for c in COUNTS])
    return flat.filter(~base_failed() & verdict(rules)).select("row.*")
