"""Documents to chunks. One input row gives many rows; nothing is shuffled."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions import keys
from gleanery.functions import text as X

# Sizes in characters and the separators, coarse to fine.
CHUNK_SIZE = 800
CHUNK_OVERLAP = 150
MIN_CHUNK_SIZE = 50
PORTION_BYTES = 4 * 2**20
SEPARATORS = ("\n## ", "\n### ", "\n\n", "\n", ". ", " ", "")


def _cuts(text: str, start: int, end: int, separator: str) -> Iterator[tuple[int, int]]:
    """Spans of ``text[start:end]``; each one but the first opens with the separator."""
    left, at = start, text.find(separator, start, end)
    while at >= 0:
        if at > left:
            yield left, at
        left, at = at, text.find(separator, at + len(separator), end)
    if end > left:
        yield left, end


def _pack(spans: list[tuple[int, int]], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Join neighbouring spans up to ``size``; step back by at most ``overlap``."""
    first = 0
    for start, end in spans:
        left = spans[first][0]
        if end - left > size and start > left:
            yield left, start
            while start > left and (start - left > overlap or end - left > size):
                first += 1
                left = spans[first][0]
    yield spans[first][0], spans[-1][1]


def recursive_spans(
    text: str, size: int, overlap: int, separators: Sequence[str], start: int = 0,
    end: int | None = None,
) -> Iterator[tuple[int, int]]:
    """Cut at the coarsest separator present, and too long pieces at finer ones.

    Pieces are spans of the text rather than copies, so the work is linear in
    the text for each separator level.
    """
    end = len(text) if end is None else end
    chosen, finer = separators[-1], ()
    for i, separator in enumerate(separators):
        if not separator or text.find(separator, start, end) >= 0:
            chosen, finer = separator, separators[i + 1:]
            break
    if not chosen:  # single characters: the windows follow from the sizes
        left = start
        while end - left > size:
            yield left, left + size
            left += size - overlap
        if end > left:
            yield left, end
        return
    waiting: list[tuple[int, int]] = []
    for span in _cuts(text, start, end, chosen):
        if span[1] - span[0] < size:
            waiting.append(span)
            continue
        if waiting:
            yield from _pack(waiting, size, overlap)
            waiting = []
        if finer:
            yield from recursive_spans(text, size, overlap, finer, *span)
        else:
            yield span
    if waiting:
        yield from _pack(waiting, size, overlap)


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in portions of about PORTION_BYTES, so that the Python texts of one portion are held at a time."""
    for batch in batches:
        if batch.num_rows:
            step = max(1, batch.num_rows * PORTION_BYTES // max(1, batch.get_total_buffer_size()))
            for i in range(0, batch.num_rows, step):
                yield batch.slice(i, step)


def recursive_chunks(
    documents: DataFrame,
    text: str = "content",
    keep: Sequence[str] = ("url", "title"),
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> DataFrame:
    """``keep.., chunk_index, chunk_text`` by recursive splitting.

    The index counts every piece that is not blank, before any size filter.
    """
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")
    narrow = documents.select(*keep, text)
    kept = [narrow.schema[c] for c in keep]
    schema = T.StructType(
        [*kept, T.StructField("chunk_index", T.IntegerType(), False),
         T.StructField("chunk_text", T.StringType(), False)]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch, source, index, piece):
            head = batch.take(pa.array(source, pa.int64())).drop_columns([text])
            return pa.RecordBatch.from_arrays(
                [*head.columns, pa.array(index, pa.int32()), pa.array(piece, pa.string())],
                schema=pa.schema([*head.schema, ("chunk_index", pa.int32()), ("chunk_text", pa.string())]),
            )

        for batch in portions(batches):
            source, index, piece = [], [], []
            for row, body in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                position = 0
                for a, b in recursive_spans(body or "", size, overlap, separators):
                    chunk = body[a:b].strip()
                    if chunk:
                        source.append(row)
                        index.append(position)
                        piece.append(chunk)
                        position += 1
            if source:
                yield out(batch, source, index, piece)

    return narrow.mapInArrow(split, schema)


def section_chunks(
    documents: DataFrame, text: str = "content", keep: Sequence[str] = ("url", "title"),
    max_level: int = 3,
) -> DataFrame:
    """Cut in front of every heading; fenced code is never cut.

    A text is first cut at its fence lines. The pieces are then in turn outside
    and inside of code, and headings are marked in the outside ones only.
    """
    sections = _sections(text, max_level)
    rows = documents.select(*keep, F.posexplode(sections).alias("chunk_index", "chunk_text"))
    heading = F.nullif(F.regexp_extract("chunk_text", rf"\A#{{1,{max_level}}} ([^\n]*)", 1), F.lit(""))
    return rows.withColumns({"heading": heading, "chunk_text": X.strip("chunk_text")})


def _sections(text: str, max_level: int) -> Column:
    mark = "\ufdd0section\ufdd1"  # two code points that no text may use
    fenced = F.split(F.col(text), r"(?m)^(?=```)")
    marked = F.transform(
        fenced,
        lambda piece, i: F.when(i % 2 == 1, piece).otherwise(
            F.regexp_replace(piece, rf"(?m)^(?=#{{1,{max_level}}} )", mark)
        ),
    )
    return F.filter(F.split(F.array_join(marked, ""), mark), lambda s: ~X.is_blank(s))


def section_then_recursive_chunks(
    documents: DataFrame, text: str = "content", keep: Sequence[str] = ("url", "title"),
    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Sections first; a section above ``size`` is split further.

    ``chunk_index`` runs through all pieces of a document, ``section`` counts its
    sections from 0, ``heading`` is the section's, null without one. Sections and
    pieces are made row by row, without a shuffle.
    """
    sections = _sections(text, max_level=3)
    narrow = documents.select(*keep, sections.alias("_sections"))
    kinds = [*narrow.drop("_sections").schema.fields, T.StructField("section", T.IntegerType()),
             T.StructField("heading", T.StringType()), T.StructField("chunk_index", T.IntegerType()), T.StructField("chunk_text", T.StringType())]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            source, section, heading, index, piece = [], [], [], [], []
            for row, bodies in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                position = 0
                for number, body in enumerate(bodies or []):
                    title = re.match("#{1,3} ([^\n]*)", body)
                    for a, b in recursive_spans(body, size, overlap, SEPARATORS):
                        chunk = body[a:b].strip()
                        if chunk:
                            source.append(row)
                            section.append(number)
                            heading.append(title[1] or None if title else None)
                            index.append(position)
                            piece.append(chunk)
                            position += 1
            head = batch.take(pa.array(source, pa.int64())).drop_columns(["_sections"])
            columns = [pa.array(section, pa.int32()), pa.array(heading, pa.string()), pa.array(index, pa.int32()), pa.array(piece, pa.string())]
            yield pa.RecordBatch.from_arrays([*head.columns, *columns], [f.name for f in kinds])

    return narrow.mapInArrow(split, T.StructType(kinds))


def fixed_chunks(
    documents: DataFrame, text: str = "content", keep: Sequence[str] = ("url", "title"),
    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Windows of ``size`` characters that share ``overlap`` with their neighbour.

    The text is cut once into strides; a window is a stride and the head of the
    next one, so a long text costs linear time. A last window that would lie
    wholly inside its predecessor is left out.
    """
    stride = size - overlap
    if not 0 <= overlap <= stride:
        raise ValueError("overlap must lie between 0 and half of the size")
    cut = documents.select(
        *keep,
        F.length(text).alias("_n"),
        F.regexp_extract_all(F.col(text), F.lit(rf"(?s).{{1,{stride}}}"), F.lit(0)).alias("_strides"),
    )
    windows = F.transform(
        F.col("_strides"),
        lambda s, i: F.concat(
            s, F.substring(F.coalesce(F.get(F.col("_strides"), i + 1), F.lit("")), 1, overlap)
        ),
    )
    rows = cut.select(*keep, "_n", F.posexplode(windows).alias("chunk_index", "chunk_text"))
    is_needed = (F.col("chunk_index") == 0) | (
        F.col("chunk_index") * stride + overlap < F.col("_n")
    )
    return rows.where(is_needed).drop("_n")


def token_chunks(
    documents: DataFrame, text: str = "content", keep: Sequence[str] = ("url", "title"),
    size: int = 200, overlap: int = 40,
) -> DataFrame:
    """Windows over whitespace-separated tokens."""
    stride = size - overlap
    if stride <= 0:
        raise ValueError("overlap must be smaller than size")
    cut = documents.select(
        *keep, F.array_remove(F.split(F.col(text), rf"[{X.WHITESPACE}]+"), "").alias("_tokens")
    )
    last = F.greatest(F.size("_tokens") - overlap - 1, F.lit(0))
    windows = F.transform(
        F.sequence(F.lit(0), last, F.lit(stride)),
        lambda at: F.array_join(F.slice(F.col("_tokens"), at + 1, size), " "),
    )
    return cut.select(*keep, F.posexplode(windows).alias("chunk_index", "chunk_text"))


#: White space that separates plain tokens.
_BLANK = " \t\n\r\f\v"
_GAP = re.compile(rf"[{_BLANK}]+")
_PLAIN_TOKEN = re.compile(rf"[^{_BLANK}]+[{_BLANK}]*")


def plain_tokens(text: str) -> list[int]:
    """Where each token begins: a run of other characters with the white space behind it."""
    return [m.start() for m in _PLAIN_TOKEN.finditer(text)]


def _cut_levels(text: str, starts: Sequence[int]) -> list[int]:
    """How coarse a cut before each token is: paragraph, line, sentence, word, inside a word."""
    gaps, ends, coarse = [], [], []  # each run of white space once, however many tokens lie in it
    for m in _GAP.finditer(text):
        lines = text.count("\n", *m.span())
        gaps.append(m.start())
        ends.append(m.end())
        coarse.append(0 if lines > 1 else 1 if lines else 2 if m.start() and text[m.start() - 1] in ".!?" else 3)
    near = (bisect_right(gaps, at) - 1 for at in starts)
    return [coarse[i] if i >= 0 and ends[i] >= at else 4 for i, at in zip(near, starts, strict=True)]


def measured_spans(text: str, starts: Sequence[int], size: int, overlap: int) -> Iterator[tuple[int, int, int]]:
    """Begin and end in characters and number of tokens of each chunk, in one pass over the tokens.

    ``starts`` says where tokens begin; what stands before the first one belongs to it. A chunk ends
    at the coarsest cut within the last half of what may still follow, the last one of
    these; the next begins ``overlap`` tokens before.
    """
    if not starts:
        return
    levels, n, first = _cut_levels(text, starts), len(starts), 0
    edges = [0, *starts[1:], len(text)]
    while n - first > size:
        low = first + max(overlap + 1, size // 2)
        end = min(range(low, first + size + 1), key=lambda i: (levels[i], -i))
        yield edges[first], edges[end], end - first
        first = end - overlap
    yield edges[first], len(text), n - first


def measured_chunks(
    documents: DataFrame, text: str = "content", keep: Sequence[str] = ("url", "title"), size: int = 200, overlap: int = 0,
    tokens: Callable[[str], Sequence[int]] = plain_tokens,
) -> DataFrame:
    """``keep.., chunk_index, n_tokens, chunk_text``: chunks of at most ``size`` tokens of the caller's own kind.

    ``tokens`` says where the tokens of a text begin, such as those of a model's tokenizer;
    chunks begin and end there. Without overlap the chunks of a text joined give the text.
    Null texts and texts without a token have none.
    """
    if not 0 <= overlap < max(1, size // 2):
        raise ValueError("overlap must be smaller than half the size")
    narrow = documents.select(*keep, F.col(text).alias("_text"))
    kept = [narrow.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("chunk_index", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("chunk_text", T.StringType())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            for row, body in enumerate(batch.column("_text").to_pylist()):
                spans = list(measured_spans(body or "", tokens(body or ""), size, overlap))
                if spans:
                    head = batch.take(pa.array([row] * len(spans), pa.int64())).drop_columns(["_text"])
                    parts = [pa.array(range(len(spans)), pa.int32()), pa.array([s[2] for s in spans], pa.int32()), pa.array([body[a:b] for a, b, _ in spans], pa.string())]
                    yield pa.RecordBatch.from_arrays([*head.columns, *parts], names=schema.names)

    return narrow.mapInArrow(split, schema)


def finish_chunks(pieces: DataFrame, min_size: int = MIN_CHUNK_SIZE) -> DataFrame:
    """Strip, drop what is shorter than ``min_size``, and add the key.

    Runs after the index was given, so dropped pieces leave gaps in it.
    """
    stripped = pieces.withColumn("chunk_text", X.strip("chunk_text"))
    return stripped.where(F.length("chunk_text") >= min_size).select(
        keys.chunk_id("url", "chunk_index").alias("chunk_id"),
        *[c for c in pieces.columns if c != "chunk_text"],
        "chunk_text",
    )
