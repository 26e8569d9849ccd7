"""Token ids in files: canonical Huffman codes of limited length, read back by table.

Ids are counted over all texts; package-merge gives the best code lengths up to a limit,
and the lengths alone give the codes (shorter first, then smaller id). A file holds a
range of documents in ascending order of their key. It begins with the code lengths;
then come blocks of at most BLOCK_TOKENS ids, each with its documents, a checksum, its
bits, and every SEGMENT ids a checkpoint: the bit at which the next id begins. A block is
decoded from all its checkpoints side by side, one table look-up an id.

Files are written by Spark's text sink, a record a line, and read as whole binary files;
both use Spark's own file systems.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain
import json
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.session import shared_dir, written

VOCABULARY, END_ID = "word_bpe_49k.json", 2
LIMIT_BITS = 16
SEGMENT = 256  # ids from one checkpoint to the next
BLOCK_TOKENS = 1 << 18
PART_TOKENS = 1 << 16  # longer documents travel in parts
FILE_TOKENS = 1 << 23
BLOCK_BYTES = 1 << 23
MOST_CACHED = 1 << 20  # pieces that a Python process keeps


# -- encoding texts -------------------------------------------------------------------

#: The steps of a tokenizer that drops white space and encodes each match of
#: a pattern by itself, in lower case.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]

#: Characters that normalisation leaves alone and that have one lower-case character; the
#: pattern for them in lower case. Texts with others are cut at white space only.
_OTHER = "[^\\t\\n\\r -~¡-ÿĀ-įı-ſЀ-џ‐-‧‰-⁞]"
_LETTER, _DIGIT = "a-zªµºß-öø-ÿā-ſа-џ", "0-9²³¹¼½¾"
_PIECE = rf"([{_LETTER}]+|[{_DIGIT}]|'(?:s|t|re|ve|m|ll|d)|[^\s{_LETTER}{_DIGIT}]+)"

#: How a byte-level vocabulary writes bytes: printable Latin-1 as it is, the rest from U+0100 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_WRITTEN = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
del _WRITTEN[0x0A]  # stands between pieces below


class Known(dict):
    """Numbers of strings; a new string gets the next number and is put on a list."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def numbers(self, strings: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, strings), np.int64, len(strings))


class Rows:
    """Rows of numbers, one behind the other, that more rows can be added to."""

    def __init__(self) -> None:
        self.values, self.ends, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        had, n = int(self.ends[self.n]), self.n + len(sizes)
        if had + len(values) > len(self.values):
            self.values = np.concatenate([self.values[:had], np.zeros(had + 2 * len(values), np.uint32)])
        if n >= len(self.ends):
            self.ends = np.concatenate([self.ends[: self.n + 1], np.zeros(n + len(sizes) + 1, np.int64)])
        self.values[had : had + len(values)] = values
        self.ends[self.n + 1 : n + 1] = had + np.cumsum(sizes)
        self.n = n

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of these rows and where each row ends among them."""
        first = self.ends[rows]
        sizes = self.ends[rows + 1] - first
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.arange(total) + np.repeat(first - (ends - sizes), sizes)], ends


def _strings(texts: list[str] | pa.Array) -> pa.Array:
    return texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())


def _offsets(lists: pa.Array) -> np.ndarray:
    return lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64) - lists.offsets[0].as_py()


class TextEncoder:
    """Ids of whole texts, as the tokenizers library gives them.

    Where the tokenizer drops white space and treats each stretch between it by itself,
    texts are cut there, and into matches of its pattern where their characters are plain;
    each different piece is encoded once in a while. Any other tokenizer gets whole texts.
    """

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        steps = json.loads(spec)
        splits = ((steps.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}])
        self.cuts = (
            (steps.get("normalizer") or {}).get("normalizers") == _NORMALIZERS and steps.get("post_processor") is None and len(splits) == 2
            and splits[0] == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
            and splits[1].get("type") == "ByteLevel" and not splits[1].get("add_prefix_space") and not splits[1].get("use_regex")
            and steps["model"]["type"] == "BPE" and not steps["model"].get("dropout")
        )
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.units, self.unit_ids = Known(), Rows()
        self.pieces, self.piece_ids = Known(), Rows()

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _ragged([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For texts of plain characters: units between blanks, of these pieces, each once."""
        lists = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        units = lists.flatten().dictionary_encode()
        inner = pc.ascii_split_whitespace(pc.replace_substring_regex(units.dictionary, _PIECE, r"\1 "))
        pieces = inner.flatten().dictionary_encode()
        numbers = self.pieces.numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        new, self.pieces.new = self.pieces.new, []
        if new:
            written_out = "\n".join(new).encode().decode("latin-1").translate(_WRITTEN).split("\n")
            self.piece_ids.add(*_ragged([[t.id for t in self.model.tokenize(p)] for p in written_out]))
        of_units = Rows()
        values, ends = self.piece_ids.take(numbers[pieces.indices.to_numpy()])
        of_units.add(values, np.diff(np.concatenate([[0], ends])[_offsets(inner)]))
        values, ends = of_units.take(units.indices.to_numpy())
        return values, np.concatenate([[0], ends])[_offsets(lists)[1:]]

    def _by_units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For any texts: units between blanks."""
        lists = [t.encode().split() for t in texts]  # ASCII blanks alone
        rows = self.units.numbers([u for x in lists for u in x])
        new, self.units.new = self.units.new, []
        if new:
            self.unit_ids.add(*self._whole([u.decode() for u in new]))
        values, ends = self.unit_ids.take(rows)
        return values, np.concatenate([[0], ends])[np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))]

    def block(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and where each text ends among them."""
        texts = _strings(texts)
        if not self.cuts:
            values, sizes = self._whole(texts.to_pylist())
            return values, np.cumsum(sizes)
        if len(self.units) > MOST_CACHED or len(self.pieces) > MOST_CACHED:
            self._forget()
        odd = pc.match_substring_regex(texts, _OTHER)
        if not pc.any(odd).as_py():
            return self._by_pieces(texts)
        mask = odd.to_numpy(zero_copy_only=False).astype(bool)
        both = Rows()
        for values, ends in (self._by_units(texts.filter(odd).to_pylist()), self._by_pieces(texts.filter(pc.invert(odd)))):
            both.add(values, np.diff(np.concatenate([[0], ends])))
        order = np.empty(len(mask), np.int64)
        order[np.concatenate([np.flatnonzero(mask), np.flatnonzero(~mask)])] = np.arange(len(mask))
        return both.take(order)


def _ragged(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array]]:
    """Texts of a batch, some megabytes at a time, with the row of the first."""
    texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        texts = pa.array([t.decode("utf-8", "replace") for t in texts.cast(pa.large_binary()).to_pylist()], pa.large_string())
    held = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        before = held[begin - 1] if begin else 0
        end = min(len(texts), int(np.searchsorted(held, before + BLOCK_BYTES)) + 1)
        yield begin, texts.slice(begin, end - begin)
        begin = end


def tokenised(documents: DataFrame, vocabulary: str, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``seq`` (place in the input), ``part``, ``last`` and ``ids`` (little-endian) of every text.

    A document is one row, or several where it is long. ids take two bytes each if the
    vocabulary allows, else four.
    """
    spec = open(vocabulary, encoding="utf-8").read()
    shared = documents.sparkSession.sparkContext.broadcast({"spec": spec})
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        if "encoder" not in tables:
            tables["encoder"] = TextEncoder(tables["spec"])  # for this process's later tasks too
        encoder = tables["encoder"]
        width = id_type(encoder.tokenizer.get_vocab_size())
        for batch in batches:
            for begin, texts in _blocks(batch):
                values, ends = encoder.block(texts)
                row, part, last, out, at = [], [], [], [], 0
                for i, end in enumerate(ends.tolist()):
                    ids = values[at:end] if end_id is None else np.append(values[at:end], np.uint32(end_id))
                    at = end
                    for k, cut in enumerate(range(0, max(len(ids), 1), PART_TOKENS)):
                        row.append(begin + i)
                        part.append(k)
                        last.append(cut + PART_TOKENS >= len(ids))
                        out.append(ids[cut : cut + PART_TOKENS].astype(width).tobytes())
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(take), batch.column("seq").take(take), pa.array(part, pa.int32()), pa.array(last, pa.bool_()), pa.array(out, pa.binary())],
                    names=["id", "seq", "part", "last", "ids"],
                )

    rows = documents.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("seq"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, seq bigint, part int, last boolean, ids binary")


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


# -- the code -------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of the best prefix code whose codes have at most ``limit`` bits; 0 for ids that do not occur.

    Package-merge: at each length pair the cheapest, add the pairs to the single ids, and
    see how many single ids are among the first 2 n - 2 at each length.
    """
    counts = np.asarray(counts, np.int64)
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if limit < 63 and len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids have no code of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    single = counts[used]
    merged, singles = single, [np.ones(len(single), bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([single, pairs])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        singles.append(order < len(single))
    take = 2 * len(single) - 2
    for is_single in reversed(singles):
        n = int(is_single[:take].sum())
        lengths[used[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: codes count up from the shortest, equal lengths by id."""
    codes = np.zeros(len(lengths), np.uint32)
    code = 0
    for size in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == size)
        code <<= 1
        codes[ids] = code + np.arange(len(ids))
        code += len(ids)
    return codes


def packed(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of the ids, first bit highest, and the checkpoints."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    total = int(ends[-1]) if len(ids) else 0
    # a code touches at most two words of 32 bits; what falls into one word adds up
    placed = codes[ids].astype(np.uint64) << (64 - (begins & 31) - size).astype(np.uint64)
    word = begins >> 5
    n = (total >> 5) + 2
    bits = np.bincount(word, placed >> np.uint64(32), n) + np.bincount(word + 1, placed & np.uint64(0xFFFFFFFF), n)
    return bits.astype(np.uint32).astype(">u4").tobytes()[: (total + 7) // 8], begins[::SEGMENT].astype("<u4")


class Table:
    """For each possible next ``limit`` bits, the id they begin with and its length."""

    def __init__(self, lengths: np.ndarray, limit: int):
        self.limit = limit
        self.ids, self.sizes = np.zeros(1 << limit, np.uint32), np.zeros(1 << limit, np.int64)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        spans = (1 << (limit - lengths[order].astype(np.int64)))
        n = int(spans.sum())
        self.ids[:n], self.sizes[:n] = np.repeat(order, spans), np.repeat(lengths[order], spans)

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids, from all checkpoints side by side."""
        data = np.frombuffer(bits + bytes(SEGMENT * 4 + 8), np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        at = checkpoints.astype(np.int64)
        out = np.empty((min(SEGMENT, n), len(at)), np.uint32)
        mask, free = (1 << self.limit) - 1, 32 - self.limit
        for k in range(len(out)):
            found = (window[at >> 3] >> (free - (at & 7)).astype(np.uint32)) & np.uint32(mask)
            out[k] = self.ids[found]
            at += self.sizes[found]
        return out.T.ravel()[:n]


# -- files ----------------------------------------------------------------------------

LINE_END = "\n"
_HEAD, _BLOCK = b"TIDF", b"TIDB"
_HEAD_FIELDS, _BLOCK_FIELDS = "<IIII", "<IIIIIII"


def head_record(number: int, lengths: np.ndarray, limit: int) -> bytes:
    squeezed = zlib.compress(lengths.astype(np.uint8).tobytes())
    return _HEAD + struct.pack(_HEAD_FIELDS, number, limit, len(lengths), len(squeezed)) + squeezed


def block_record(number: int, entries: list[tuple[str | None, int, bool]], ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    """``entries``: for each document in the block its key, how many ids, and whether it ends here."""
    bits, checkpoints = packed(ids, codes, lengths)
    index = zlib.compress(json.dumps(entries, separators=(",", ":")).encode(), 1)
    marks = zlib.compress(checkpoints.tobytes(), 1)
    body = index + marks + bits
    return _BLOCK + struct.pack(_BLOCK_FIELDS, number, len(ids), len(index), len(marks), len(bits), zlib.crc32(body), zlib.crc32(ids.astype("<u4").tobytes())) + body


def parsed(data: bytes) -> Iterator[tuple[int, list[tuple[str | None, int, bool]], np.ndarray]]:
    """File number, documents and ids of each block of a file; ValueError if it is damaged."""
    at, table = 0, None
    while at < len(data):
        kind, at = data[at : at + 4], at + 4
        if kind == _HEAD:
            _, limit, size, n = struct.unpack_from(_HEAD_FIELDS, data, at)
            at += struct.calcsize(_HEAD_FIELDS)
            lengths = np.frombuffer(zlib.decompress(data[at : at + n]), np.uint8)
            if len(lengths) != size:
                raise ValueError("the code has another size than stated")
            table, at = Table(lengths, limit), at + n
        elif kind == _BLOCK and table is not None:
            number, n, a, b, c, check, ids_check = struct.unpack_from(_BLOCK_FIELDS, data, at)
            at += struct.calcsize(_BLOCK_FIELDS)
            body = data[at : at + a + b + c]
            if len(body) != a + b + c or zlib.crc32(body) != check:
                raise ValueError("a block is damaged")
            ids = table.decode(body[a + b :], np.frombuffer(zlib.decompress(body[a : a + b]), "<u4"), n)
            if zlib.crc32(ids.astype("<u4").tobytes()) != ids_check:
                raise ValueError("a block decodes to other ids")
            yield number, json.loads(zlib.decompress(body[:a])), ids
            at += a + b + c
        else:
            raise ValueError("no token file")
        if data[at : at + 1] != LINE_END.encode():
            raise ValueError("a record does not end")
        at += 1


def counted(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents. Each task sends at most one row for each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            held, n = [], 0
            for i, ids in enumerate(b.column("ids")):
                held.append(ids.as_py())
                n += len(held[-1])
                if n > 1 << 22 or i == b.num_rows - 1:
                    total += np.bincount(np.frombuffer(b"".join(held), id_type(size)), minlength=size)
                    held, n = [], 0
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    counts = np.zeros(size, np.int64)
    for id_, n in rows:
        counts[id_] = n
    return counts


def write_files(tokens: DataFrame, path: str, size: int, limit: int = LIMIT_BITS) -> None:
    """Write ``tokens`` (of ``tokenised``) in ascending order of ``id``, nulls first, ties in input order."""
    counts = counted(tokens, size)
    limit = max(limit, int(np.count_nonzero(counts)).bit_length())
    lengths = code_lengths(counts, limit)
    shared = tokens.sparkSession.sparkContext.broadcast((lengths, canonical(lengths)))
    files = max(1, -(-int(counts.sum()) // FILE_TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        lengths, codes = shared.value
        entries, held, n, begun = [], [], 0, False

        def record() -> pa.RecordBatch:
            data = block_record(number, entries, np.concatenate(held), codes, lengths)
            return pa.RecordBatch.from_arrays([pa.array([data] if begun else [head_record(number, lengths, limit), data], pa.binary())], names=["record"])

        for b in batches:
            for id_, last, ids in zip(b.column("id").to_pylist(), b.column("last").to_pylist(), b.column("ids"), strict=True):
                values = np.frombuffer(ids.as_buffer(), id_type(size))
                if n and n + len(values) > BLOCK_TOKENS:
                    yield record()
                    entries, held, n, begun = [], [], 0, True
                entries.append((id_, len(values), last))
                held.append(values)
                n += len(values)
        if entries:
            yield record()

    ordered = tokens.repartitionByRange(files, "id", "seq").sortWithinPartitions("id", "seq", "part")
    records = ordered.select(F.col("id").cast("string").alias("id"), "last", "ids").mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", LINE_END).text(path)


def read_files(spark: SparkSession, path: str, digest: Callable[[np.ndarray, int], int] | None = None) -> DataFrame:
    """``id`` (as text), ``file``, ``place`` (ids before it in its file), ``n_tokens`` and ``ids`` of each document.

    With ``digest(ids, value so far)``, ``digest`` instead of ``ids``, so that a long
    document is never held whole. A file is read by one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("file", pa.int32()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("digest", pa.int64()) if digest else ("ids", pa.list_(pa.int64()))])
        for b in batches:
            for content in b.column("content"):
                place, n, state = 0, 0, 0 if digest else []
                for number, entries, ids in parsed(content.as_py()):
                    rows, at = [], 0
                    for id_, size, last in entries:
                        own = ids[at : at + size]
                        at, n = at + size, n + size
                        state = digest(own, state) if digest else state + own.tolist()
                        if last:
                            rows.append((id_, number, place, n, state))
                            place, n, state = place + n, 0, 0 if digest else []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    last = "digest bigint" if digest else "ids array<bigint>"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, f"id string, file int, place bigint, n_tokens bigint, {last}")


def crc32(ids: np.ndarray, before: int) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers, carried on."""
    return zlib.crc32(ids.astype("<u4").tobytes(), before)


def round_trip(documents: DataFrame, vocabulary: str | None = None, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BITS) -> DataFrame:
    """Write the ids of all texts to files in the shared folder and read them back.

    For each row: the id column, ``start`` (ids of all documents before it), ``n_tokens``
    and ``digest`` (CRC-32). Null and empty texts have the end id only. Documents come in
    ascending order of the id column, null ids first; rows with equal ids follow each
    other in input order. Bytes that are no UTF-8 become U+FFFD. An empty table gives no
    rows. No column but the two named is looked at. Rows of one id may be spread over
    files; a document is in one file.
    """
    spark, path = documents.sparkSession, shared_dir(documents.sparkSession, "token-files")
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    size = Tokenizer.from_file(vocabulary).get_vocab_size()
    tokens = tokenised(documents, vocabulary, end_id, id_col, text_col)
    token_path = shared_dir(spark, "tokens")
    tokens.write.option("compression", "zstd").parquet(token_path)
    write_files(spark.read.parquet(token_path), path, size, limit)
    read = written(read_files(spark, path, crc32), "token-index")
    # one row for each file: what the files before it hold
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = read.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    bases = files.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    kind = documents.schema[id_col].dataType.simpleString()
    return read.join(bases, "file").select(F.col("id").cast(kind).alias(id_col), (F.col("base") + F.col("place")).alias("start"), "n_tokens", "digest")
