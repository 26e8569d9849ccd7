"""The corpus pipeline, stage by stage, each against a brute-force version on its own input."""

from collections import Counter

import corpus_pipeline
from gleanery.llm import language_id, queries, quality_rules, simhash
from gleanery.llm.common import held_out
from gleanery.session import written
from test_tables import components_by_hand, mixed_by_hand
from test_texts import brute_counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = [f for _, f in corpus_pipeline.STAGES]

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.fit(docs, labels)
    good = written(stage[0](spark, docs, sf_dir), "test")
    assert good.columns == COLUMNS
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, rules).collect()}
    assert rows_of(good) == Counter({k: n for k, n in rows_of(docs).items() if kept[k[0]]})
    for k in rows_of(docs):
        n, _, _, _, repeat = brute_counts(k[1])
        assert not (kept[k[0]] and (n < 50 or 100 * repeat > 50 * n))

    known = written(stage[1](spark, good, sf_dir), "test")
    model = language_id.fit(good.filter(~held_out(good.doc_id)))
    assert rows_of(known) == Counter({k: n for k, n in rows_of(good).items() if not language_id.score_text(model, k[1])[2]})

    different = written(stage[2](spark, known, sf_dir), "test")
    rows = [(k[0], simhash.fingerprint(k[1].encode())) for k in rows_of(known)]
    least = components_by_hand(rows)
    assert rows_of(different) == Counter({k: 1 for k, (i, f) in zip(rows_of(known), rows, strict=True) if least[f] == i})

    mix = written(stage[3](spark, different, sf_dir), "test")
    taken = {r[0]: r[4] // r[1] for r in mixed_by_hand([(k[0], k[1], k[3]) for k in rows_of(different)])}
    assert rows_of(mix) == Counter({k: taken[k[0]] for k in rows_of(different) if taken[k[0]]})

    last = stage[4](spark, mix, sf_dir)
    want = {r.doc_id: r for r in queries.op8_bpe(spark, sf_dir).collect()}
    got = last.collect()
    assert len(got) == mix.count() and all(want[r.doc_id] == r for r in got)


def test_stages_take_odd_tables(spark, sf_dir):
    odd = spark.createDataFrame([(None, None, None, None, None, "x"), (1, "", "en", "a", 0, "x"), (2, "é " * 100, None, None, 200, "x"), (2, "é " * 100, None, None, 200, "x")], "doc_id long, text string, lang string, source string, n_chars long, `Row` string")
    for frame in (odd, odd.limit(0)):
        for _, f in corpus_pipeline.STAGES[:-1]:
            out = f(spark, frame, sf_dir)
            assert out.columns == odd.columns and out.count() <= 2 * frame.count() + 1
        assert corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).count() == frame.count()


def test_run(spark, sf_dir):
    first, second = (sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) for _ in range(2))
    assert first and first == second
