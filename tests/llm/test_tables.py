"""Mixing, sharding, top-k search and SimHash against brute force, with edge cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from gleanery.llm import mixing, queries, sharding, simhash, topk_tiles

DOCS = "doc_id long, text string, lang string, source string, size string, `Key` int"


def mixed_by_hand(rows, weights=(5.0, 2.0, 1.0)):
    size = lambda t: len((t or "").encode().split())
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(size(t) for _, t, x in rows if x == s) for s in sources}
    weight = {s: weights[i % 3] for i, s in enumerate(sources)}
    total, clamped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in sources if s not in clamped)
        level = (total - sum(2.0 * sizes[s] for s in clamped)) / rest if rest else float("inf")
        more = {s for s in sources if weight[s] * level > 2 * sizes[s]}
        if more <= clamped:
            break
        clamped |= more
    out = []
    for s in sources:
        target = min(weight[s] * level, 2.0 * sizes[s])
        whole = int(target // sizes[s]) if sizes[s] else 0
        quota, below, extra = int(target + 0.5) - whole * sizes[s], 0, {}
        groups = {}
        for i, t, x in rows:
            if x == s:
                groups.setdefault(hashlib.md5(f"20:{'null' if i is None else i}".encode()).hexdigest(), []).append(size(t))
        for key in sorted(groups):
            words = sum(groups[key])
            extra[key] = 2 * below + words <= 2 * quota
            below += words
        for i, t, x in rows:
            if x == s:
                key = hashlib.md5(f"20:{'null' if i is None else i}".encode()).hexdigest()
                out.append((i, size(t), sizes[s], target, size(t) * (whole + extra[key]) if size(t) else 0))
    return out


def test_mix_matches_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "hot", "hot", "hot", "é", None])) for i in range(300)]
    rows += [(None, "x y", "a"), (7, "again and again", "hot"), (7, "again and again", "hot"), (400, None, None), (401, "", "empty"), (402, "z " * 20000, "b")]
    df = spark.createDataFrame([(i, t, None, s, "clash", 1) for i, t, s in rows], DOCS)
    got = sorted(map(tuple, mixing.mix(df).collect()), key=repr)
    assert got == sorted(mixed_by_hand(rows), key=repr)
    taken = mixing.mixed(df)
    assert taken.columns == df.columns
    assert taken.agg(F.sum(mixing.n_words(F.col("text")))).head()[0] == sum(r[4] for r in got)


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    empty = spark.createDataFrame([(1, None, None, "a", "x", 1)], DOCS)
    assert [tuple(r) for r in mixing.mix(empty).collect()] == [(1, 0, 0, 0.0, 0)]


def test_mix_cut_does_not_depend_on_levels(spark, monkeypatch):
    rows = [(i, "w " * (i % 13), "s" if i % 3 else "t") for i in range(400)]
    df = spark.createDataFrame([(i, t, None, s, "x", 1) for i, t, s in rows], DOCS)
    want = sorted(map(tuple, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "LEVELS", 1)
    assert sorted(map(tuple, mixing.mix(df).collect())) == want


def table_by_hand(shards, slots):
    """The same table from its definition: permutations written out, then turns."""
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    order = {s: [(number(f"offset:{s}") % slots + j * (number(f"skip:{s}") % (slots - 1) + 1)) % slots for j in range(slots)] for s in shards}
    owner = {}
    turn = 0
    while len(owner) < slots:
        s = shards[turn % len(shards)]
        owner[next(x for x in order[s] if x not in owner)] = s
        turn += 1
    return owner


def test_sharding_matches_brute_force(spark, sf_dir):
    owner = table_by_hand(list(queries.SHARDS), sharding.SLOTS)
    for r in queries.op10_sharding(spark, sf_dir).collect():
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, owner[slot])


def test_sharding_table_is_even_and_stable():
    names = [f"s{i}" for i in range(20)]
    full, less = sharding.filled(names, 4099), sharding.filled(names[:-1], 4099)
    sizes = np.bincount(full)
    assert sizes.max() - sizes.min() <= 1
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != 19)
    assert moved < 0.1 * 4099
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.filled(bad)
    with pytest.raises(ValueError):
        sharding.filled(names, 4098)


def test_sharding_edges(spark, tmp_path):
    df = spark.createDataFrame([(None, "a", "x", "s", "1", 1), (1, None, None, None, None, None), (1, "b", "x", "s", "1", 2), (2, "", "x", "s", "1", 3)], DOCS)
    got = sharding.placed(df, "doc_id", ["p", "q", "r"], 101).collect()
    assert len(got) == 4 and len({r.shard for r in got if r.doc_id == 1}) == 1
    assert sharding.placed(df.limit(0), "doc_id", ["p"], 101).count() == 0
    sharding.write_shards(df, "doc_id", ["p", "q", "r"], str(tmp_path / "out"), 101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4 and set(back.columns) == {*df.columns, "shard"}


def search_by_hand(rows, queries_, k):
    usable = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i in queries_:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, q in asked.items():
        hits = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in usable if j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(hits[:k])]
    return sorted(out)


def test_search_matches_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.5, 0.25, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(400)]
    rows += [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (None, [1.0] * 6), (3, [9.0] * 6), (10, [0.1] * 6), (600, [1.0, 2.0]), (601, [2.0, 1.0]), (602, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("id", F.lit(1)).repartition(5)
    real = [(r.vec_id, r.embedding) for r in df.collect()]
    chosen = [0, 10, 20, 500, 502, 600, 602]
    want = search_by_hand(real, chosen, 10)
    asked = df.filter(F.col("vec_id").isin(chosen))
    assert sorted(map(tuple, topk_tiles.search(df, asked).collect())) == want
    monkeypatch.setattr(topk_tiles, "TILE", 7)
    monkeypatch.setattr(topk_tiles, "FAN_IN", 2)
    assert sorted(map(tuple, topk_tiles.search(df, asked, slice_bytes=100).collect())) == want
    assert topk_tiles.search(df.limit(0), df.limit(0)).count() == 0


def test_products_are_exact_beyond_doubles():
    a = np.array([[(1 << 40) + 1, 3]], np.int64)
    assert topk_tiles.product(a, np.array([[1 << 20, 1]], np.int64))[0, 0] == ((1 << 40) + 1) * (1 << 20) + 3
    with pytest.raises(OverflowError):
        topk_tiles.product(a * 1024, a * 1024)


def test_topk_drops_no_large_component(spark):
    df = spark.createDataFrame([(1, [0.0, 2.0**-10]), (2, [2.0**52, 1.0]), (3, [-(2.0**52.5), 2.0]), (4, [float("inf"), 3.0]), (None, [2.0**60, 4.0])], "vec_id long, embedding array<double>")
    got = topk_tiles.search(df, df.filter("vec_id = 1")).collect()
    assert [(r.vec_id, r.score) for r in got] == [(3, 2048), (2, 1024)]
    with pytest.raises(Exception, match="does not fit into a long"):
        topk_tiles.search(df.union(spark.createDataFrame([(5, [2.0**53, 1.0])], df.schema)), df.filter("vec_id = 1")).collect()


def by_hand(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), seed=42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(rows, limit=4):
    prints = sorted({f for _, f in rows})
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= limit:
                parent[find(a)] = find(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return {f: least.get(find(f)) for f in prints}


def test_fingerprints_match_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op3_simhash(spark, sf_dir).collect()
    assert all(int(r.fingerprint, 16) == by_hand(texts[r.doc_id]) and len(r.fingerprint) == 16 for r in rows)
    want = components_by_hand([(r.doc_id, int(r.fingerprint, 16)) for r in rows])
    assert all(want[int(r.fingerprint, 16)] == r.component_id for r in rows)
    for text in (None, "", "one", "É Ä A", "a b c", "a b c d", "x" * 70000 + " y z w v", "w " * 40000):
        assert simhash.fingerprint(None if text is None else text.encode()) == by_hand(text)


@pytest.mark.parametrize("most", [4096, 40, 6])
def test_components_match_brute_force(spark, most):
    rng = random.Random(9)
    prints = []
    for _ in range(12):  # clusters, some of them chains that span more than the limit
        f = rng.getrandbits(64)
        for _ in range(rng.choice([3, 60])):
            prints.append(f)
            g = f
            for _ in range(rng.randint(1, 4)):
                g ^= 1 << rng.randrange(64)
            f = rng.choice([f, g])
    prints += [rng.getrandbits(64) for _ in range(150)] + [0, 0, 1, (1 << 64) - 1]
    rows = [(i, f) for i, f in enumerate(prints)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, simhash.signed(f)) for i, f in rows], "id long, fp long")
    got = {r.fp % (1 << 64): r.component_id for r in simhash.classes(df, most=most).collect()}
    assert got == components_by_hand(rows)


def test_simhash_edges(spark):
    words = " ".join(f"w{i}" for i in range(200))
    rows = [(1, None), (2, ""), (3, " \n"), (4, words), (4, words), (5, words.upper()), (None, words), (6, "other text here now"), (6, "and this one is quite another")]
    df = spark.createDataFrame([(i, t, None, "s", "fp", 1) for i, t in rows], DOCS)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == sorted([(False, 1, 1), (False, 2, 1), (False, 3, 1), (False, 4, 4), (False, 4, 4), (False, 5, 4), (True, 0, 4), (False, 6, 6), (False, 6, 6)])
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(1, ""), (4, words), (0, words), (6, "other text here now"), (6, "and this one is quite another")])
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_first(df.limit(0)).count() == 0
