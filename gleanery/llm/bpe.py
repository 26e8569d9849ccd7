"""Byte-level BPE by a finite-state transducer, and its streaming decoder.

Merging by rank gives each byte string exactly one sequence of tokens, and a sequence is
the right one if and only if each pair of neighbours is: no merge across their seam
would have come before those that made the two. So the last token of every prefix is
unique, and reading left to right needs only the starts from which a token may still be
open. ``Transducer`` keeps these as one state: for each open start its place in the
vocabulary's trie and the last token before it; the state's output is the last token of
the prefix read so far. From there the tokens are followed back. In a long piece that
is done every ``LOOKAHEAD`` bytes, up to the boundary that all open starts have behind
them, so output lags by a bounded number of bytes. States and moves are made when first
met and kept up to a bound.

Texts are encoded in blocks. The different pieces of a block step through the automaton
side by side: one look-up in a dense table of moves for all of them at each byte, and the
moves not met yet are made together. What runs of letters between spaces became is kept
for later blocks, up to a bound.

Ranks must rise along merges, and each token must be what its own bytes are merged to;
both are checked when compiling.
"""

from __future__ import annotations

from array import array
import base64
import codecs
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import regex

RANKS = "byte_bpe_50k.tiktoken"
LOOKAHEAD = 4096
MOST_STATES = 120_000
MOVE_BITS = 20  # the table of moves has 2 to this many places; it is emptied when half full
MOST_PAIRS = 100_000
#: Pieces of more characters are read one by one.
SIDE_BY_SIDE = 96
#: Characters of text in a block; a longer text is a block of its own.
BLOCK_CHARS = 1 << 20
#: Characters of units whose tokens are kept for later blocks.
KEPT_CHARS = 1 << 21
NEVER = 1 << 30  # a rank that no merge has


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merged(ranks: dict[bytes, int], piece: bytes, parts_left: int = 1) -> list[bytes]:
    """Plain merging by rank, leftmost first among equals, down to ``parts_left`` parts."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > parts_left:
        best, at = None, 0
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def places(keys: np.ndarray, size: int) -> np.ndarray:
    """Where keys are looked for first in a table of ``size`` places, a power of two."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def look_up(table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The value of each key in a table with open addressing, or -1."""
    out, rows, at = np.full(len(keys), -1, np.int32), np.arange(len(keys)), places(keys, len(table))
    while len(rows):
        there = table[at]
        hit = there == keys
        out[rows[hit]] = values[at[hit]]
        on = ~hit & (there >= 0)
        rows, keys, at = rows[on], keys[on], (at[on] + 1) & (len(table) - 1)
    return out


def put_all(table: np.ndarray, values: np.ndarray, keys: np.ndarray, new: np.ndarray) -> None:
    """Put in different keys that the table does not have."""
    at = places(keys, len(table))
    while len(keys):
        free = table[at] < 0
        table[at[free]] = keys[free]  # of several keys for a place one stays
        here = table[at] == keys
        values[at[here]] = new[here]
        keys, new, at = keys[~here], new[~here], (at[~here] + 1) & (len(table) - 1)


def table_of(found: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """A table with open addressing, a quarter full to a half."""
    size = 2 << len(found).bit_length()
    table, values = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    put_all(table, values, np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), np.int32, len(found)))
    return table, values


class Compiled:
    """The rank file as a trie and as merge trees; sent to the executors once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.step: dict[int, int] = {}  # trie node * 256 + byte to node
        self.token: list[int] = [-1]
        for data, rank in ranks.items():
            self.bytes_of[rank] = data
            node = 0
            for b in data:
                key = node << 8 | b
                node = self.step.get(key) or self.step.setdefault(key, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node] = rank
        self.size = list(map(len, self.bytes_of))
        self.depth = [0] * len(self.token)
        self.inner = bytearray(len(self.token))  # 1 for nodes that go on
        for key, node in self.step.items():
            self.depth[node] = self.depth[key >> 8] + 1  # a parent is made before its children
            self.inner[key >> 8] = 1
        #: The two parts that make a token; None for a single byte.
        self.parts: list[tuple[int, int] | None] = [None] * len(self.bytes_of)
        for data, rank in ranks.items():
            if len(data) > 1:
                left, right = (merged(ranks, data, 2) + [b""])[:2]
                if merged(ranks, data) != [data] or max(ranks[left], ranks[right]) >= rank:
                    raise ValueError(f"token {rank} is not what its bytes are merged to, or its rank is below a part's")
                self.parts[rank] = (ranks[left], ranks[right])
        self._tabulate()

    def _tabulate(self) -> None:
        """The same for many look-ups at once."""
        self.step_table = table_of(self.step)
        self.token_at = np.array(self.token, np.int32)
        self.goes_on = np.frombuffer(bytes(self.inner), np.uint8).astype(bool)
        #: left << 17 | right to the rank of the two together
        self.joins = table_of({
            self.ranks[data[:i]] << 17 | self.ranks[data[i:]]: rank
            for data, rank in self.ranks.items() for i in range(1, len(data)) if data[:i] in self.ranks and data[i:] in self.ranks
        })
        #: For both edges: offsets by token, parts on the edge, and the ranks that end them.
        self.edges = []
        for right in (0, 1):
            spines = [self.spine(t, right) if data else [] for t, data in enumerate(self.bytes_of)]
            flat = list(chain.from_iterable(spines))
            self.edges.append((
                np.concatenate([[0], np.cumsum([len(x) for x in spines])]), np.array([a for a, _ in flat], np.int64),
                np.array([NEVER if end == float("inf") else end for _, end in flat], np.int64),
            ))

    def spine(self, token: int, right: int) -> list[tuple[int, float]]:
        """Parts on one edge of a token, outermost first, each with the rank that ends it."""
        found, at, end = [], token, float("inf")
        while True:
            found.append((at, end))
            if self.parts[at] is None:
                return found
            at, end = self.parts[at][right], at

    def fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`Transducer.fits` of many pairs at once."""
        (l_at, a_of, a_end_of), (r_at, b_of, b_end_of) = self.edges[1], self.edges[0]
        n_right = r_at[right + 1] - r_at[right]
        counts = (l_at[left + 1] - l_at[left]) * n_right
        pair = np.repeat(np.arange(len(left)), counts)
        i, j = np.divmod(np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts), n_right[pair])
        i += l_at[left][pair]
        j += r_at[right][pair]
        a, b, a_end, b_end = a_of[i], b_of[j], a_end_of[i], b_end_of[j]
        both = np.flatnonzero((a < b_end) & (b < a_end))  # there at the same time
        rank = look_up(*self.joins, a[both] << 17 | b[both])
        over = (rank >= 0) & (rank < a_end[both]) & (rank <= b_end[both])
        out = np.ones(len(left), bool)
        out[pair[both[over]]] = False
        return out

    @classmethod
    def of(cls, tables: dict) -> Compiled:
        """From the plain tables of another one, as a broadcast carries them."""
        new = cls.__new__(cls)
        new.__dict__.update(tables)
        return new


def ready(tables: dict, pattern: str) -> Encoder:
    """What this process has learnt so far, kept beside the broadcast tables for its later tasks."""
    if ("encoder", pattern) not in tables:
        plain = {k: v for k, v in tables.items() if isinstance(k, str)}
        tables["encoder", pattern] = Encoder(Transducer(Compiled.of(plain)), pattern)
    return tables["encoder", pattern]


class Transducer:
    """Lazily determinised: ``encode`` gives the tokens of one piece in one pass over its bytes."""

    def __init__(self, compiled: Compiled):
        self.c = compiled
        self.pairs: dict[int, bool] = {}  # left << 17 | right
        self.spines: tuple[dict, dict] = ({}, {})
        self._clear()

    def _clear(self) -> None:
        first = array("q", [0]).tobytes()
        self.number = {first: 0}  # a state's open starts, 8 bytes for each node << 17 | last token + 1
        self.states = [first]
        self.last = [-1]
        # open addressing: state << 8 | byte to state, looked up for many pieces at once
        self.keys = np.full(1 << MOVE_BITS, -1, np.int64)
        self.to = np.zeros(1 << MOVE_BITS, np.int32)
        self.moves = 0
        self.single: dict[int, int] = {}  # the same for pieces that are read one by one

    def tidy(self) -> None:
        """Forget everything if that has become much; between texts only."""
        if self.full():
            self._clear()

    def full(self) -> bool:
        return len(self.states) > MOST_STATES or 2 * self.moves > len(self.keys)

    def _put(self, keys: np.ndarray, to: np.ndarray) -> None:
        if 10 * (self.moves + len(keys)) > 8 * len(self.keys):  # a single block with that many moves
            self.keys.fill(-1)
            self.moves, keys, to = 0, keys[-len(self.keys) // 2 :], to[-len(self.keys) // 2 :]
        put_all(self.keys, self.to, keys, to)
        self.moves += len(keys)

    def _spine(self, token: int, right: int) -> list[tuple[int, float]]:
        found = self.spines[right].get(token)
        if found is None:
            found = self.spines[right][token] = self.c.spine(token, right)
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether the two stay apart: no merge over the seam comes before those beside it."""
        known = self.pairs.get(left << 17 | right)
        if known is None:
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
                self.spines = ({}, {})
            known = True
            ranks, data = self.c.ranks, self.c.bytes_of
            for a, a_end in self._spine(left, 1):
                for b, b_end in self._spine(right, 0):
                    if a < b_end and b < a_end:  # there at the same time
                        rank = ranks.get(data[a] + data[b])
                        # leftmost first: the seam comes after merges to its left, before those to its right
                        if rank is not None and rank < a_end and rank <= b_end:
                            known = False
                            break
                if not known:
                    break
            self.pairs[left << 17 | right] = known
        return known

    def _move(self, state: int, byte: int) -> int:
        step, token, inner = self.c.step, self.c.token, self.c.inner
        open_, closed, pairs = [], -1, self.pairs
        for start in memoryview(self.states[state]).cast("q"):
            node = step.get(start >> 17 << 8 | byte)
            if node is None:
                continue
            last = start & 0x1FFFF
            if inner[node]:
                open_.append(node << 17 | last)
            t = token[node]
            if t >= 0 and closed < 0:
                fits = not last or pairs.get(last - 1 << 17 | t)
                if self.fits(last - 1, t) if fits is None else fits:
                    closed = t
        open_.append(closed + 1)  # every prefix has its last token, as all single bytes are tokens
        to = self._state(array("q", open_).tobytes(), closed)
        self._put(np.array([state << 8 | byte]), np.array([to], np.int32))
        return to

    def _moves(self, keys: np.ndarray) -> np.ndarray:
        """:meth:`_move` for many different moves at once."""
        c = self.c
        held = [self.states[s] for s in (keys >> 8).tolist()]
        starts = np.frombuffer(b"".join(held), np.int64)
        owner = np.repeat(np.arange(len(keys)), np.fromiter(map(len, held), np.int64, len(held)) >> 3)
        node = look_up(*c.step_table, starts >> 17 << 8 | (keys & 255)[owner]).astype(np.int64)
        on = node >= 0
        node, owner, last = node[on], owner[on], starts[on] & 0x1FFFF
        token = c.token_at[node]
        # the first start of each whose token fits: one more of them is tried in each turn
        closed = np.full(len(keys), -1, np.int64)
        ends = np.flatnonzero(token >= 0)
        while len(ends):
            first = np.ones(len(ends), bool)
            first[1:] = owner[ends[1:]] != owner[ends[:-1]]
            tried = ends[first]
            fits = last[tried] == 0
            fits[~fits] = c.fit(last[tried[~fits]] - 1, token[tried[~fits]])
            closed[owner[tried[fits]]] = token[tried[fits]]
            ends = ends[~first]
            ends = ends[closed[owner[ends]] < 0]
        stay = c.goes_on[node]
        counts = np.bincount(owner[stay], minlength=len(keys)) + 1
        stops = np.cumsum(counts)
        flat = np.empty(stops[-1], np.int64)
        flat[stops - 1] = closed + 1
        inner = np.ones(len(flat), bool)
        inner[stops - 1] = False
        flat[inner] = node[stay] << 17 | last[stay]
        data, begin, out = flat.tobytes(), 0, []
        for stop, t in zip((stops << 3).tolist(), closed.tolist(), strict=True):
            out.append(self._state(data[begin:stop], t))
            begin = stop
        to = np.array(out, np.int32)
        self._put(keys, to)
        return to

    def _state(self, starts: bytes, last: int) -> int:
        to = self.number.get(starts)
        if to is None:
            to = self.number[starts] = len(self.states)
            self.states.append(starts)
            self.last.append(last)
        return to

    def _back(self, ends: list[int], at: int) -> list[int]:
        """The tokens up to a boundary; ``ends`` has the last token of each prefix."""
        out = []
        while at > 0:
            t = ends[at - 1]
            out.append(t)
            at -= self.c.size[t]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one piece of any length."""
        self.tidy()
        out, ends, state = [], [], 0
        for at in range(0, len(piece), LOOKAHEAD):
            more, state = self._read(piece[at : at + LOOKAHEAD], state)
            ends += more
            if at + LOOKAHEAD >= len(piece):
                break
            # the boundary that all open starts come from
            starts = {len(ends) - self.c.depth[s >> 17] for s in memoryview(self.states[state]).cast("q")}
            while len(starts) > 1:
                top = max(starts)
                starts = starts - {top} | {top - self.c.size[ends[top - 1]]}
            settled = starts.pop()
            out += self._back(ends, settled)
            ends = ends[settled:]
            if self.full():
                here, last = self.states[state], self.last[state]
                self._clear()
                state = self._state(here, last)
        return out + self._back(ends, len(ends))

    def _read(self, data: bytes, state: int) -> tuple[list[int], int]:
        """The last token of each prefix, and the state reached."""
        ends = []
        for byte in data:
            key = state << 8 | byte
            to = self.single.get(key)
            if to is None:
                to = int(look_up(self.keys, self.to, np.array([key]))[0])
                to = self.single[key] = self._move(state, byte) if to < 0 else to
            state = to
            ends.append(self.last[state])
        return ends, state

    def encode_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and tokens of many short pieces, stepping side by side."""
        self.tidy()
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        codes = np.frombuffer(b"".join(pieces), np.uint8)
        codes = codes.astype(np.int64)
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        left = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")  # pieces longer than i
        reached, state = np.empty(len(codes), np.int32), np.zeros(len(pieces), np.int32)
        for i, k in enumerate(left):
            at = starts[:k] + i
            keys = state[:k].astype(np.int64) << 8 | codes[at]
            to = look_up(self.keys, self.to, keys)
            new = np.flatnonzero(to < 0)
            if len(new):
                kinds, back = np.unique(keys[new], return_inverse=True)
                to[new] = self._moves(kinds)[back]
            state[:k] = to
            reached[at] = to
        ends = np.array(self.last, np.int32)[reached]
        # follow the tokens back
        sizes, at, rows = np.asarray(self.c.size), lengths[order], np.arange(len(pieces))
        rows = rows[at > 0]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        counts = np.zeros(len(pieces), np.int64)
        while len(rows):
            t = ends[starts[rows] + at[rows] - 1]
            found.append((rows, t))
            counts[rows] += 1
            at[rows] -= sizes[t]
            rows = rows[at[rows] > 0]
        of_piece = np.empty(len(pieces), np.int64)
        of_piece[order] = counts
        offsets = np.concatenate([[0], np.cumsum(of_piece)])
        tokens = np.empty(offsets[-1], np.int32)
        for j, (rows, t) in enumerate(found):
            tokens[offsets[order[rows] + 1] - 1 - j] = t
        return offsets, tokens


def ragged(offsets: np.ndarray, values: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of the rows ``take`` of a ragged array."""
    counts = (offsets[1:] - offsets[:-1])[take]
    ends = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(ends[-1]) + np.repeat(offsets[:-1][take] - ends[:-1], counts)
    return ends, values[at]


#: A gap that ends in a space and begins with another blank; such texts are not cut at spaces.
_WIDE_GAP = regex.compile(r"\s ")
_ASCII_GAPS = tuple(f"{chr(c)} " for c in (*range(0x09, 0x0E), *range(0x1C, 0x21)))


def has_wide_gap(text: str) -> bool:
    return any(g in text for g in _ASCII_GAPS) if text.isascii() else bool(_WIDE_GAP.search(text))


class Encoder:
    """Encodes blocks of texts, each match of the pattern by itself.

    A match of PATTERN ends before any run of white space, so where runs that hold a space
    are single spaces, a text is cut before each space, and equal units are encoded once.
    Any other pattern runs over whole texts.
    """

    def __init__(self, transducer: Transducer, pattern: str):
        self.transducer, self.pattern = transducer, regex.compile(pattern)
        self.cuts = pattern == public_tokenizers.PATTERN
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}  # units met, numbered
        self.stops, self.values, self.held = np.zeros(1, np.int64), np.empty(0, np.int32), 0  # their tokens, and their characters

    def found(self, text: str) -> list[str]:
        return [m[0] for m in self.pattern.finditer(text)] if self.pattern.groups else self.pattern.findall(text)

    def block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of the texts."""
        units: list[str] = []
        ends = [0]
        for text in texts:
            if text and not self.cuts:
                units.append(text)
            elif text and has_wide_gap(text):
                units += _cut_wide(text)
            elif text:
                first, *rest = text.split(" ")
                units += [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]
            ends.append(len(units))
        new = [u for u in dict.fromkeys(units) if u not in self.number]
        if new:
            self._learn(new)
        take = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        unit_offsets, ids = ragged(self.stops, self.values, take)
        if self.held > KEPT_CHARS:
            self._forget()
        return unit_offsets[np.array(ends)], ids

    def _learn(self, units: list[str]) -> None:
        """Encodes different units that are not known yet."""
        # what would run into its neighbour when joined to it, and long units, by themselves
        plain, apart = [], []
        for u in units:
            (plain if self.cuts and u[0] == " " and len(u) <= SIDE_BY_SIDE and not u[-1].isspace() else apart).append(u)
        pieces = self.found("".join(plain))
        if sum(map(len, pieces)) != sum(map(len, plain)):  # a pattern that passes text over
            plain, apart, pieces = [], units, []
        parts = [self.found(u) for u in apart]
        kinds = {p: i for i, p in enumerate(dict.fromkeys(chain(pieces, (p for x in parts for p in x if len(p) <= SIDE_BY_SIDE))))}
        offsets, tokens = self.transducer.encode_all(list(map(str.encode, kinds)))
        kind = np.fromiter(map(kinds.__getitem__, pieces), np.int64, len(pieces))
        ends_p, tokens_p = ragged(offsets, tokens, kind)
        # units are runs of whole pieces: pieces that end where a unit ends
        piece_ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        unit_ends = np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)))
        stops = ends_p[np.searchsorted(piece_ends, unit_ends) + 1] if len(plain) else np.zeros(0, np.int64)
        others = []
        for x in parts:
            ids = [tokens[offsets[kinds[p]] : offsets[kinds[p] + 1]] if p in kinds else np.array(self.transducer.encode(p.encode()), np.int32) for p in x]
            others.append(np.concatenate(ids) if ids else tokens[:0])
        stops = np.concatenate([stops, (ends_p[-1] if len(pieces) else 0) + np.cumsum([len(x) for x in others])]).astype(np.int64)
        for u in chain(plain, apart):
            self.number[u] = len(self.number)
        self.stops = np.concatenate([self.stops, self.stops[-1] + stops])
        self.values = np.concatenate([self.values, tokens_p, *others]).astype(np.int32)
        self.held += sum(map(len, units))


def encode_text(encoder: Encoder, text: str) -> np.ndarray:
    return encoder.block([text])[1]


def _cut_wide(text: str) -> Iterator[str]:
    """Cuts before each run of white space, so that memory stays with one unit."""
    at = 0
    for m in regex.finditer(r"\s+", text):
        if m.start() > at:
            yield text[at : m.start()]
        at = m.start()
    if at < len(text):
        yield text[at:]


def encode(documents: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and ``ids`` of every whole text; null and empty texts have none.

    No special tokens. One row for each input row; other columns are not looked at. The
    rank file is read and compiled on the driver and broadcast; its size is fixed.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(Compiled(read_ranks(path or public_tokenizers.path(RANKS)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ready(shared.value, pattern)
        for batch in batches:
            for ids_of, offsets, ids in _blocks(encoder, batch):
                yield pa.RecordBatch.from_arrays([ids_of, _lists(offsets, ids)], names=["id", "ids"])

    kind = documents.schema[id_col].dataType.simpleString()
    plain = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def round_trip(documents: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``ids`` and ``decoded``: ``encode`` and ``decode`` in one pass.

    One Python process a task does both, so the ids cross to Python once and only one
    vocabulary is in memory.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(Compiled(read_ranks(path or public_tokenizers.path(RANKS)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, vocabulary = ready(shared.value, pattern), shared.value["bytes_of"]
        for batch in batches:
            for ids_of, offsets, ids in _blocks(encoder, batch):
                texts = [decoded(vocabulary, ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([ids_of, _lists(offsets, ids), pa.array(texts, pa.string())], names=["id", "ids", "decoded"])

    kind = documents.schema[id_col].dataType.simpleString()
    plain = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def _blocks(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Row ids, offsets and token ids of blocks of bounded size, whatever came in."""
    texts, ids_of, begin = batch.column("text"), batch.column("id"), 0
    texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
    while begin < batch.num_rows:
        block, held = [], 0
        while begin + len(block) < batch.num_rows and held < BLOCK_CHARS:
            block.append((texts[begin + len(block)].as_py() or b"").decode("utf-8", "replace"))
            held += len(block[-1])
        offsets, ids = encoder.block(block)
        yield ids_of.slice(begin, len(block)), offsets, ids
        begin += len(block)


def _lists(offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))


def decoded(bytes_of: list[bytes], ids: list[int], step: int = 4096) -> str:
    """Text of token ids, streamed: tokens end anywhere within a character.

    The state between steps is that of an incremental UTF-8 decoder. Bytes that are no
    UTF-8 become U+FFFD; an id outside of the vocabulary is an error.
    """
    machine, out = codecs.getincrementaldecoder("utf-8")("replace"), []
    for at in range(0, len(ids), step):
        out.append(machine.decode(b"".join(map(bytes_of.__getitem__, ids[at : at + step]))))
    out.append(machine.decode(b"", True))
    return "".join(out)


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """All other columns and ``decoded``, the text of the ids; null ids are an empty text."""
    ranks = read_ranks(path or public_tokenizers.path(RANKS))
    bytes_of = [b""] * (max(ranks.values()) + 1)
    for data, rank in ranks.items():
        bytes_of[rank] = data
    shared = encoded.sparkSession.sparkContext.broadcast(bytes_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            others = [n for n in batch.schema.names if n != ids_col]
            lists, rows, held, begin = batch.column(ids_col), [], 0, 0
            for i in range(len(lists)):
                rows.append(decoded(vocabulary, lists[i].values.to_numpy().tolist() if lists[i].is_valid else []))
                held += len(rows[-1])
                if held > 1 << 23 or i == len(lists) - 1:
                    yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(begin, len(rows)) for n in others), pa.array(rows, pa.string())], names=[*others, "decoded"])
                    rows, held, begin = [], 0, i + 1

    names = [c for c in encoded.columns if c != ids_col]
    schema = ", ".join([*(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in names), "decoded string"])
    return encoded.select(*names, ids_col).mapInArrow(run, schema)
