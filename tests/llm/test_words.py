"""Token files and periodic runs: brute force, round trips, odd input."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import periodic_runs, queries, spelling, token_files

SF = "/root/testdata/sf0.01"
ODD = "doc_id bigint, text string, id string, part int, last string, seq int, runs int"


def odd_rows(spark):
    long = " ".join(random.Random(5).choices(["alpha", "beta", "gamma,", "É"], k=150_000))
    rows = [(3, "one two"), (None, "no id"), (1, None), (2, ""), (2, "  \t\n "), (2, "a\x1cb “x” 中文 <|endoftext|>"), (7, "x " * 40), (7, "x " * 40), (9, long)]
    return spark.createDataFrame([(i, t, "clash", 1, "l", 2, 3) for i, t in rows], ODD)


# -- token files


@pytest.mark.parametrize("limit", [4, 8, 16])
@pytest.mark.parametrize("n", [1, 2, 3, 16, 200])
def test_codes_are_prefix_free_and_short(limit, n):
    if n > 1 << limit:
        return
    counts = np.minimum(np.random.default_rng(n).pareto(0.4, n) * 3, 1e12).astype(np.int64) + 1
    lengths = token_files.code_lengths(counts, limit)
    codes = token_files.canonical(lengths)
    words = sorted(f"{c:0{k}b}" for c, k in zip(codes.tolist(), lengths.tolist(), strict=True))
    assert lengths.max() <= limit and not any(b.startswith(a) for a, b in zip(words, words[1:], strict=False))
    ids = np.random.default_rng(1).integers(0, n, 5000).astype(np.uint32)
    bits, checkpoints = token_files.packed(ids, codes, lengths)
    assert (token_files.Table(lengths, limit).decode(bits, checkpoints, len(ids)) == ids).all()


def test_code_is_the_best_one():
    """Against Huffman's own algorithm, where the limit does not bind."""
    import heapq

    counts = np.random.default_rng(3).integers(1, 1000, 60)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        heapq.heappush(heap, pair := heapq.heappop(heap) + heapq.heappop(heap))
        cost += pair
    assert int((counts * token_files.code_lengths(counts, 20)).sum()) == cost
    tight = token_files.code_lengths(counts, 6)
    assert tight.max() == 6 and sum(2.0 ** -int(x) for x in tight) == 1
    with pytest.raises(ValueError):
        token_files.code_lengths(counts, 5)


def test_ids_equal_the_library():
    spec = open(public_tokenizers.path(token_files.VOCABULARY), encoding="utf-8").read()
    encoder = token_files.TextEncoder(spec)
    rng = random.Random(2)
    plain = [c for lo, hi in ((0x21, 0x7E), (0xA1, 0x17F), (0x400, 0x45F), (0x2010, 0x2027), (0x2030, 0x205E)) for c in map(chr, range(lo, hi + 1))]
    chars = [*plain, *" \t\n\r\x0b\x1c\x1f\x85\xa0" * 8, *"'srtvemld" * 9, *"中😀Σςǅﬁ̸́ ​≯"]
    texts = ["".join(rng.choices(chars, k=rng.randint(0, 40))) for _ in range(4000)] + plain + [a + b for a in "a1'!" for b in plain]
    values, ends = encoder.block(texts)
    begin = 0
    for text, end in zip(texts, ends.tolist(), strict=True):
        assert values[begin:end].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
        begin = end


def by_library(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    tokenizer.encode_special_tokens = True
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_gives_back_all_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    found = queries.op12_token_files(spark, SF).orderBy("start").collect()
    assert [tuple(r) for r in found] == by_library(rows)


def test_files_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_TOKENS", 50_000)
    monkeypatch.setattr(token_files, "PART_TOKENS", 1000)
    rows = odd_rows(spark)
    found = [tuple(r) for r in token_files.round_trip(rows).orderBy("start").collect()]
    order = sorted(((r.doc_id, r.text) for r in rows.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert found == by_library(order)
    assert token_files.round_trip(rows.limit(0)).collect() == []
    bad = spark.sql("select 1L as doc_id, cast(x'61FF62' as string) as text")
    assert [tuple(r) for r in token_files.round_trip(bad).collect()] == by_library([(1, "a�b")])


def test_damaged_files_are_noticed():
    counts = np.arange(1, 60)
    lengths = token_files.code_lengths(counts, 16)
    codes, ids = token_files.canonical(lengths), np.arange(59, dtype=np.uint32)
    good = token_files.head_record(0, lengths, 16) + b"\n" + token_files.block_record(0, [("1", 59, True)], ids, codes, lengths) + b"\n"
    [(number, entries, back)] = token_files.parsed(good)
    assert number == 0 and entries == [["1", 59, True]] and (back == ids).all()
    for bad in (good[:-9] + b"xxxxxxxx\n", good[:-1], good[: len(good) - 20], b"junk" + good):
        with pytest.raises(ValueError):
            list(token_files.parsed(bad))


# -- periodic runs


def brute_runs(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_words(rng):
    kind, k, n = rng.randrange(5), rng.choice([1, 2, 2, 3]), rng.randint(0, 90)
    words = rng.choices(range(k), k=n)
    if kind == 1:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 2:
        words = (rng.choices(range(k), k=rng.randint(1, 20)) * 20)[:n]
        for _ in range(rng.randint(0, 3) if words else 0):
            words[rng.randrange(len(words))] = 9
    if kind == 3:
        return (words[: n // 3] * rng.randint(1, 4) + [7]) * rng.randint(1, 3)
    if kind == 4:
        return (([0, 1] * rng.randint(1, 12) + [0]) * rng.randint(1, 4) + [0, 1] * rng.randint(1, 12)) * rng.randint(1, 3)
    return words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(3000):
        words, least = periodic_words(rng), rng.choice([2, 3, 5, 8, 12, 12, 16])
        assert [tuple(r) for r in periodic_runs.find_runs(np.array(words, np.int64), least).tolist()] == brute_runs(words, least)


def test_runs_of_long_repeats_take_little():
    import time

    began = time.process_time()
    assert periodic_runs.find_runs(np.zeros(500_000, np.int64)).tolist() == [[0, 500_000, 1]]
    assert len(periodic_runs.find_runs(np.tile(np.array([0, 1] * 50 + [0]), 3000))) > 1000
    assert time.process_time() - began < 20


def expected_row(doc_id, text):
    words = queries.planted(doc_id, (text or "").encode().split())
    runs, drop = brute_runs(words, 12), set()
    for s, n, q in runs:
        drop |= set(range(s + q, s + n))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    """Over short documents of the table, planted ones among them, and odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.length("text") < 4000)
    odd = odd_rows(spark).filter("doc_id is null or doc_id < 9")
    docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    found = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == sorted((expected_row(*r) for r in rows), key=str)
    assert sum(r.n_runs > 0 for r in found) > 20


def test_planting_follows_its_rule():
    words = [b"%d" % i for i in range(100)]
    for doc_id in range(400):
        h = zlib.crc32(b"%d" % doc_id)
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        expected = [w if h % 10 or i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert queries.planted(doc_id, words) == expected


def test_runs_of_odd_rows(spark):
    found = periodic_runs.periodic_runs(odd_rows(spark)).collect()
    assert len(found) == 9 and periodic_runs.periodic_runs(odd_rows(spark).limit(0)).collect() == []
    for r in found:
        if r.doc_id == 7:
            assert [tuple(x) for x in r.runs] == [(0, 40, 1)] and r.collapsed == "x"
        if r.doc_id == 1 or (r.doc_id == 2 and r.n_words == 0):
            assert (r.n_words, r.runs, r.collapsed) == (0, [], "")
    bad = spark.sql("select 1L as doc_id, repeat(cast(x'FF20' as string), 20) as text")
    [row] = periodic_runs.periodic_runs(bad).select("runs", F.hex("collapsed")).collect()
    assert [tuple(x) for x in row[0]] == [(0, 20, 1)] and row[1] == "FF"


# -- spelling variants


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def variants_by_hand(counts):
    near = {w: [x for x in counts if x != w and one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def words_frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


@pytest.mark.parametrize("most_pairs", [4096, 4, 1])
def test_variants_equal_brute_force(spark, monkeypatch, most_pairs):
    """Few letters, so that words have many neighbours and groups are cut often."""
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (most_pairs,))
    rng = random.Random(most_pairs)
    counts = {"".join(rng.choices("abé", k=rng.randint(1, 8))): int(rng.paretovariate(0.5)) for _ in range(500)}
    counts |= {"aaaaaa" + c + "b" * 6: 5**i for i, c in enumerate("abcdefghijklm")}
    found = spelling.variants(words_frame(spark, counts)).collect()
    assert sorted(map(tuple, found)) == variants_by_hand(counts)


def test_words_that_share_a_half(spark):
    """Thousands of words under one chunk: no pair is lost, few are compared."""
    rng = random.Random(4)
    counts = {"pre" * 4 + "".join(rng.choices("abcdefghij", k=12)): 5 for _ in range(6000)}
    for w in list(counts)[:300]:
        i = rng.randrange(12, 24)
        counts[w[:i] + "z" + w[i + 1 :]] = 30
    found = {r.word: r for r in spelling.variants(words_frame(spark, counts)).collect()}
    assert len(found) == len(counts)
    assert sum(r.form is not None for r in found.values()) == 300
    assert all(one_edit(r.word, r.form) and r.form_n == 30 for r in found.values() if r.form)


def test_words_of_odd_texts(spark):
    rows = odd_rows(spark).select("doc_id", "text", "id", "part").unionByName(spark.createDataFrame([(5, "Straße STRAße×÷ strÀße", "x", 1)], "doc_id bigint, text string, id string, part int"))
    found = {r.word: r.n for r in spelling.counted(rows, min_chars=1, min_count=1).collect()}
    assert found["straße"] == 1 and found["straße×÷"] == 1 and found["strÀße"] == 1 and found["one"] == 1 and found["x"] == 81
    assert found["É"] + found["alpha"] + found["beta"] + found["gamma"] == 150_000
    assert spelling.spelling_variants(rows.limit(0)).collect() == []
    bad = spark.sql("select 1L as doc_id, cast(unhex('6162FF6364C3') as string) as text")
    assert {r.word for r in spelling.counted(bad, min_chars=1, min_count=1).collect()} == {"ab", "cd"}


def test_words_equal_the_pattern():
    import re

    rng = random.Random(6)
    chars = "abZ é×÷ÿÀ¿Āſ中😀-'1\n"
    for _ in range(3000):
        text = "".join(rng.choices(chars, k=rng.randint(0, 20)))
        expected = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[A-Za-zÀ-ÿ]+", text)]
        assert [w.decode() for w in spelling.words_of(text.encode())] == expected


def test_letters_are_dropped_by_the_rule():
    words = {f"word{'abcdefghij'[i % 10] * (i // 10)}é".encode() for i in range(400)}
    changed = 0
    for doc_id in (7, 12345, None):
        out = spelling.dropped_letters(doc_id, words)
        for w in words:
            h, chars = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode() + w), w.decode()
            at = h % len(chars)
            assert out.get(w, w).decode() == (chars[:at] + chars[at + 1 :] if h % 199 == 0 else chars)
        changed += len(out)
    assert changed
