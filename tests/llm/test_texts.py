"""Language ID, quality rules and quality classifier: fixtures, edge cases, held-out accuracy."""

from collections import Counter
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import bpe, language_id, quality_cnn, quality_rules, queries
from gleanery.llm.common import bounded_sample, held_out

DOCS = "doc_id long, text string, lang string, source string, Score string, `fp` int"
EDGES = [
    (1, None, "en", "a", "x", 1), (2, "", None, None, None, None), (None, "some words without an id", "en", "a", "x", 1),
    (3, "123 456 !!!", "en", "a", "x", 2), (4, "the cat sat on the mat\n" * 3000, "en", "b", "x", 3), (4, "the cat sat on the mat\n" * 3000, "en", "b", "x", 3),
    (5, " \t\n\x0b\x0c\r ", "de", "b", "y", 4),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


def brute_counts(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_language_edges(spark, edges):
    train = spark.createDataFrame([(i, t, lang, "s", "z", 1) for i, (t, lang) in enumerate([("the cat and the dog are in the house", "en"), ("der hund und die katze sind im haus", "de")] * 20)], DOCS)
    model = language_id.fit(train)
    got = {(r.doc_id, r.lang_pred): r for r in language_id.predict(edges, model).collect()}
    assert len(language_id.predict(edges, model).collect()) == len(EDGES)
    for key in (1, 2, 3, 5):
        assert got[key, "und"].score == 0.0 and got[key, "und"].rejected
    assert (4, "en") in got and (None, "en") in got
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = language_id.keep_recognised(edges, model)
    assert kept.columns == edges.columns and {r.doc_id for r in kept.collect()} <= {4, None}


def test_language_without_labels(spark, edges):
    none = language_id.fit(edges.limit(0))
    assert none is None
    assert {r.lang_pred for r in language_id.predict(edges, none).collect()} == {"und"}
    assert language_id.predict(edges.limit(0), none).count() == 0


def test_long_texts_are_counted_across_steps(monkeypatch):
    text = "Eine Reihe von Wörtern, größer als ein Schritt. " * 50
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "STEP", 97)
    assert (language_id.ngram_counts(text) == whole).all()


def softmax_by_hand(model, text):
    """Probabilities from n-grams cut and hashed one by one."""
    data = b" " + text.lower().encode() + b" "
    data = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in data)
    hit, met, n = Counter(), 0, 0
    for size in (2, 3, 4):
        for i in range(len(data) - size + 1):
            h = size * 0x9E3779B1 % 2**32
            for b in data[i : i + size]:
                h = h * 0x01000193 % 2**32 ^ b
            h = h * 0x85EBCA6B % 2**32
            hit[h >> 18] += 1
            g = ((h ^ h >> 15) * 0x2C1B3C6D % 2**32) >> 10
            met += int(model.met[g // 8]) >> g % 8 & 1
            n += 1
    z = [(sum(k * float(model.table[b, j]) for b, k in hit.items()) / n + float(model.bias[j])) / model.temperature for j in range(len(model.langs))]
    e = [np.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e], met / n


def test_language_scores_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit(docs.filter(~held_out(docs.doc_id)))
    texts = [r.text for r in docs.collect() if r.text and 20 < len(r.text) < 1500][:25] + ["Ж щ", "a"]
    for text in texts:
        p, known = softmax_by_hand(model, text)
        lang, score, rejected = language_id.score_text(model, text)
        assert score == pytest.approx(max(p), abs=1e-4) and lang == model.langs[int(np.argmax(p))]
        if abs(max(p) - model.least_probability) > 1e-3 and abs(known - model.least_seen) > 1e-6:
            assert rejected == (max(p) < model.least_probability or known < model.least_seen)


def test_samples_do_not_depend_on_partitions(spark):
    rows = [(i % 40, f"text {i}") for i in range(3000)] + [(7, "the same")] * 3000 + [(None, "x")] * 9
    df = spark.createDataFrame(rows, "id int, text string")
    for n in (1, 50, 3001, 9000):
        got = [sorted(map(tuple, bounded_sample(df.repartition(k), "id", n, 3).collect())) for k in (1, 7)]
        assert got[0] == got[1] and len(got[0]) == min(n, 3001) == len(set(got[0]))
        assert all(r[0] is not None for r in got[0])
    assert bounded_sample(df.limit(0), "id", 5, 3).count() == 0


def test_rules_of_repeated_ids_do_not_depend_on_partitions(spark):
    docs = [(i % 30, ("good words stand here in order %d " % i) * 12 if i % 2 else ("# $ & bad %d # " % i) * 12) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id int, quality int")
    df = spark.createDataFrame(docs, "doc_id int, text string")
    first, second = (quality_rules.fit(df.repartition(k), labels, rows=10) for k in (1, 5))
    assert first == second


def test_bytes_that_are_no_utf8(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    bad = docs.limit(20).withColumn("text", F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF20C3"))).cast("string"))
    both = docs.unionByName(bad)
    model, rules = language_id.fit(both), quality_rules.fit(both, labels)
    assert language_id.predict(bad, model).count() == 20
    assert language_id.keep_recognised(bad, model).count() <= 20
    assert quality_rules.judge(bad, rules).count() == 20 and quality_rules.keep_good(bad, rules).count() <= 20
    back = bpe.round_trip(bad).collect()
    want = {r.doc_id: bytes(r.data).decode("utf-8", "replace") for r in bad.select("doc_id", F.col("text").cast("binary").alias("data")).collect()}
    assert len(back) == 20 and all(r.decoded == want[r.doc_id] for r in back)


@pytest.mark.parametrize("foreign", [
    "Zażółć gęślą jaźń, wszyscy ludzie rodzą się wolni i równi w godności", "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι",
])
def test_rejects_languages_of_large_tables(large_model, foreign):
    assert language_id.score_text(large_model, foreign)[2]


@pytest.fixture(scope="module")
def large_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return language_id.fit(docs.filter(~held_out(docs.doc_id)))


def test_language_held_out(spark, sf_dir):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    out = [r for r in rows if r.held_out and r.lang]
    assert sum(r.lang_pred == r.lang for r in out) > 0.97 * len(out)
    assert sum(r.rejected for r in rows) < 0.02 * len(rows)
    letters = language_id.softmax(np.array([1000.0, 0.0]))
    assert letters[0] == pytest.approx(1)


def test_rejects_an_unknown_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs.filter(~held_out(docs.doc_id)))
    assert language_id.score_text(model, "Это совсем другой язык, которого модель никогда не видела")[2]
    assert language_id.score_text(model, None) == ("und", 0.0, True)


def test_counts_match_brute_force(spark, edges, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op4_quality_rules(spark, sf_dir).collect():
        n, chars, symbols, dup, repeat = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (r.base_failed and r.kept)
    for text in ["", None, "a b c a b c", "a a a a", "é ç\n\né ç\n \n", "x " * 7, "# | <>"]:
        assert quality_rules.text_counts(None if text is None else text.encode())[:5] == (lambda b: (b[0], b[1], b[2], b[3], b[4]))(brute_counts(text))
    rows = quality_rules.judge(edges, []).collect()
    assert len(rows) == len(EDGES) and all(r.base_failed for r in rows)


def test_decision_list_learns_and_prints():
    rng = np.random.default_rng(1)
    counts = np.zeros((600, len(quality_rules.COUNTS)), np.int64)
    counts[:, 0] = rng.integers(60, 400, 600)
    counts[:, 1] = counts[:, 0] * 5
    bad = rng.random(600) < 0.2
    counts[bad, 2] = counts[bad, 0] // 2
    rules = quality_rules.learn(counts, bad)
    values = quality_rules.ratios(counts)
    hit = np.zeros(600, bool)
    for r in rules:
        hit |= quality_rules.covers(r, values)
    assert (hit == bad).all() and "symbols_per_word >" in " and ".join(map(str, rules[0]))
    assert quality_rules.learn(counts[:0], bad[:0]) == [] and quality_rules.learn(counts, np.zeros(600, bool)) == []


def test_rules_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [r for r in queries.op4_quality_rules(spark, d).collect() if r.doc_id in labels and not r.base_failed and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good = [r for r in rows if labels[r.doc_id]]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in rows if not labels[r.doc_id]) >= 0.9 * (len(rows) - len(good))


def test_keep_good_keeps_columns(spark, edges):
    kept = quality_rules.keep_good(edges, [])
    assert kept.columns == edges.columns and kept.count() == 0
    good = spark.createDataFrame([(9, " ".join(f"word{i}" for i in range(60)), "en", "a", "x", 1)], DOCS)
    assert quality_rules.keep_good(good, []).collect() == good.collect()


def test_gradients_are_those_of_the_loss():
    net, data = quality_cnn.fresh(1), b"Some words, then OTHERS!! " * 40
    found, _ = quality_cnn.gradients(net, data, 1)
    for part, g in zip(net.parts(), found, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), part.shape)
        old, losses = part[at], []
        for move in (2e-3, -2e-3):
            part[at] = old + move
            losses.append(quality_cnn.gradients(net, data, 1)[1])
        part[at] = old
        assert (losses[0] - losses[1]) / 4e-3 == pytest.approx(g[at], rel=0.05)


def test_network_covers_whole_texts(monkeypatch):
    net = quality_cnn.fresh(2)
    data = bytes(np.random.default_rng(3).integers(32, 127, 5000, dtype=np.uint8))
    whole = quality_cnn.probability(net, data)
    monkeypatch.setattr(quality_cnn, "STEP", quality_cnn.HALF * quality_cnn.STRIDE)
    assert quality_cnn.probability(net, data) == pytest.approx(whole, abs=1e-6)
    assert quality_cnn.probability(net, None) == quality_cnn.probability(net, b"")


def test_classifier_edges(spark, edges):
    net = quality_cnn.train([])
    rows = quality_cnn.score(edges, net).collect()
    assert len(rows) == len(EDGES) and all(r.score == 0.5 for r in rows)
    assert quality_cnn.score(edges.limit(0), net).count() == 0
    assert quality_cnn.fit(edges, spark.createDataFrame([], "doc_id long, quality int, toxic int")).offset[0] == 0


def test_classifier_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect() if r.quality is not None}
    rows = [(r.score, labels[r.doc_id], r.predicted) for r in queries.op5_quality_classifier(spark, d).collect() if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q, _ in rows if q], [s for s, q, _ in rows if not q]
    auc = np.mean([np.mean([(g > b) + 0.5 * (g == b) for b in bad]) for g in good])
    assert auc > 0.95
    assert all(p == (s >= 0.3) for s, _, p in rows)
