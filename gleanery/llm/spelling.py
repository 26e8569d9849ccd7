"""Spelling variants: words one edit apart, found with asymmetric chunks.

Of two words at most one edit apart, the longer (of equal lengths either) gives two
disjoint chunks, its first and its last half; the other gives its positional grams of that
size. One edit leaves one chunk whole, and it is found in the other word at its place or,
behind a deletion, one place to the left. So only grams at those places are sent, and
words that share a chunk are compared: an equal chunk must be within shift one, and the
exact distance decides.

A chunk that many words share is cut further in the same way: between the words that share
it the edit lies in what it leaves over, whose halves are chunks again. This goes on until
each group has few pairs or a single character is left, where all that meet are neighbours;
so what is compared grows with the words, and no link is lost.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import texts_of
from gleanery.session import written

MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
MOST_PAIRS = 4096  # a group of more possible pairs is cut further
HELD_WORDS = 1 << 19  # different words a task counts before it hands them on

#: Lowers A to Z; what else is no letter becomes a space. Bytes of longer characters stay.
_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: UTF-8 of U+00C0 to U+00FF is 0xC3 and one more byte.
_OTHER = re.compile(rb"[\xc0-\xc2\xc4-\xff]|\xc3(?![\x80-\xbf])|(?<!\xc3)[\x80-\xbf]")


def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of A to Z, a to z and U+00C0 to U+00FF, with A to Z lowered."""
    low = text.translate(_LOWERED)
    if not low.isascii() and _OTHER.search(low):
        low = re.sub(rb"[\xc0-\xc2\xc4-\xff][\x80-\xbf]*|\xc3(?![\x80-\xbf])|(?<!\xc3)[\x80-\xbf]", b" ", low)
    return low.split()


def counted(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[object, set[bytes]], dict[bytes, bytes]] | None = None, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n``: lower-cased runs of letters (only A to Z are lowered) with enough characters and occurrences.

    ``rewrite(id, words)`` may give other words for some of a row's words. Null and empty
    texts have no words. Words are counted in each task before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def held() -> pa.RecordBatch:
            long = [(w, n) for w, n in total.items() if n and len(w) >= min_chars and (len(w) >= 2 * min_chars or len(w.decode()) >= min_chars)]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in long], pa.binary()), pa.array([n for _, n in long], pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column("id")
            for i, text in enumerate(texts_of(batch)):
                words = words_of(text or b"")
                total.update(words)
                for word, other in (rewrite(ids[i].as_py(), set(words)) if rewrite else {}).items():
                    n = words.count(word)
                    total[word] -= n
                    total[other] += n
                if len(total) > HELD_WORDS:
                    yield held()
                    total.clear()
        yield held()

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word binary, n bigint")
    counts = rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    return counts.select(F.col("word").cast("string").alias("word"), "n")


def _cut(rows: DataFrame) -> DataFrame:
    """Each row twice: its key goes on with the first or the last half of what is left of the word.

    ``at`` and ``left`` say what is left, ``shift`` how much shorter the word is than the
    one whose chunks it is to meet: the last half is then found that much further left.
    """
    half = F.floor((F.col("left") + F.col("shift")) / 2).cast("int")
    first = F.struct(
        F.xxhash64("key", F.lit(0), F.col("word").substr(F.col("at"), half)).alias("key"), (F.col("at") + half).alias("at"), (F.col("left") - half).alias("left")
    )
    last_at = F.col("at") + F.col("left") - half
    last = F.struct(F.xxhash64("key", F.lit(1), F.col("word").substr(last_at, half)).alias("key"), F.col("at").alias("at"), (F.col("left") - half).alias("left"))
    return rows.select("word", "shift", "chunks", F.explode(F.array(first, last)).alias("c")).select("word", "shift", "chunks", "c.key", "c.at", "c.left")


def near_pairs(words: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``a`` and ``b`` for all words one edit apart, each pair once; ``words`` has ``word``, each once.

    Words that share a chunk are joined on its hash, and the distance is verified, so
    equal hashes of different chunks do no harm. Each round writes what is too crowded
    still; its number of rows at most doubles, and rounds are as many as the longest word
    has halvings.
    """
    whole = words.select("word", F.char_length("word").alias("size")).filter("size > 0")
    chunks = whole.select("word", F.lit(0).alias("shift"), F.lit(True).alias("chunks"), F.xxhash64("size").alias("key"), F.lit(1).alias("at"), F.col("size").alias("left"))
    grams = whole.select("word", F.explode(F.array(F.lit(0), F.lit(1))).alias("shift"), "size").select(
        "word", "shift", F.lit(False).alias("chunks"), F.xxhash64(F.col("size") + F.col("shift")).alias("key"), F.lit(1).alias("at"), F.col("size").alias("left")
    )
    rows, found = chunks.unionByName(grams), []
    while True:
        rows = written(_cut(rows), "spelling-chunks")
        sizes = rows.groupBy("key").agg(
            F.sum(F.col("chunks").cast("bigint")).alias("c"), F.sum((~F.col("chunks")).cast("bigint")).alias("g"), F.max(F.col("left") + F.col("shift")).alias("most")
        ).filter("c > 0 AND g > 0")
        # a word meets its own grams under the keys of its chunks; alone there, it has no partner
        sizes = written(sizes.filter("c > 1 OR g > 1").select("key", ((F.col("c") * F.col("g") > most_pairs) & (F.col("most") > 1)).alias("crowded")), "spelling-keys")
        met = rows.join(sizes.filter("NOT crowded").select("key"), "key", "left_semi")
        a = met.filter("chunks").select("key", F.col("word").alias("a"))
        b = met.filter("NOT chunks").select("key", F.col("word").alias("b"), "shift")
        pairs = a.join(b, "key").filter("(shift = 1 OR a < b) AND levenshtein(a, b, 1) = 1 AND char_length(a) = char_length(b) + shift")
        found.append(written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "spelling-pairs"))
        crowded = sizes.filter("crowded").select("key")
        if crowded.isEmpty():
            break
        rows = rows.join(crowded, "key", "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for each row of ``words`` (``word``, ``n``).

    A word's form is its most frequent neighbour (of equal ones the first in code-point
    order), if that is at least ``ratio`` times as frequent; its root is where following
    forms ends. Frequencies grow by ``ratio`` from form to form, so a chain ends after as
    many steps as the largest count has powers of ``ratio``, and each round doubles the
    steps taken. An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent, or they go in circles")
    words = written(words.select("word", "n"), "spelling-words")
    pairs = written(near_pairs(words), "spelling-near")
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("other_n"))
    # the largest (n, first word): counts down, words up
    best = ends.join(other, "b").groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    near = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    has = -F.col("best.less") >= ratio * F.col("n")
    near = written(near.select(
        "word", F.when(has, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(has, -F.col("best.less")).alias("form_n")
    ), "spelling-forms")
    step = near.filter("form IS NOT NULL").select("word", F.col("form").alias("to"))
    while True:
        further = step.select(F.col("word").alias("to"), F.col("to").alias("next"))
        moved = written(step.join(further, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        step = moved.select("word", "to")
        if moved.filter("moved").isEmpty():
            break
    roots = step.withColumnRenamed("to", "root")
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[object, set[bytes]], dict[bytes, bytes]] | None = None, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``variants`` of the words that all texts have.

    Null and empty texts have no words; repeated rows count as often as they stand there;
    bytes that are no UTF-8 separate words. No column but the two named is looked at.
    """
    return variants(counted(documents, id_col, text_col, rewrite, min_chars, min_count), ratio)


def dropped_letters(key: object, words: set[bytes]) -> dict[bytes, bytes]:
    """Every 199th word or so without one of its characters, as a checksum of ``<key>:<word>`` says; a null key is empty."""
    before, out = zlib.crc32(f"{'' if key is None else key}:".encode()), {}
    for word in words:
        if not (h := zlib.crc32(word, before)) % 199:
            chars = word.decode()
            at = h % len(chars)
            out[word] = (chars[:at] + chars[at + 1 :]).encode()
    return out
