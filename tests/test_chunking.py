import time

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from gleanery.operators import chunking
from gleanery.plans import ingest


def literal_split(text, size, overlap, separators):
    """Recursive splitting on lists of strings, step by step; slow and obvious."""

    def merge(parts):
        out, held = [], []
        for part in parts:
            if sum(map(len, held)) + len(part) > size and held:
                out.append("".join(held).strip())
                while held and (
                    sum(map(len, held)) > overlap or sum(map(len, held)) + len(part) > size
                ):
                    held.pop(0)
            held.append(part)
        return [c for c in [*out, "".join(held).strip()] if c]

    separator, rest = separators[-1], []
    for i, s in enumerate(separators):
        if s == "" or s in text:
            separator, rest = s, separators[i + 1:]
            break
    if separator:
        first, *others = text.split(separator)
        parts = [p for p in [first, *(separator + o for o in others)] if p]
    else:
        parts = list(text)
    chunks, short = [], []
    for part in parts:
        if len(part) < size:
            short.append(part)
            continue
        chunks += merge(short) if short else []
        short = []
        chunks += literal_split(part, size, overlap, rest) if rest else [part]
    return chunks + (merge(short) if short else [])


def spans(text, size, overlap, separators=chunking.SEPARATORS):
    found = (text[a:b].strip() for a, b in chunking.recursive_spans(text, size, overlap, separators))
    return [c for c in found if c]


pieces = st.lists(
    st.sampled_from(["\n## ", "\n### ", "\n\n", "\n", ". ", " ", "a", "bc", "word", "longerword", "é", "😀"]), max_size=120
).map("".join)


@settings(max_examples=400, deadline=None)
@given(pieces, st.integers(2, 40), st.data())
def test_spans_equal_a_literal_reading(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    want = literal_split(text, size, overlap, list(chunking.SEPARATORS)) if text else []
    assert spans(text, size, overlap) == want


@settings(max_examples=200, deadline=None)
@given(pieces, st.integers(2, 40))
def test_chunks_are_short_parts_of_the_text(text, size):
    at = 0
    for a, b in chunking.recursive_spans(text, size, size // 3, chunking.SEPARATORS):
        assert b - a <= size and a >= at
        at = a


def test_a_run_without_separators():
    assert [len(c) for c in spans("x" * 2000, 800, 150)] == [800, 800, 700]


def test_splitting_is_linear():
    took = []
    for n in (100_000, 400_000):
        text = ("word " * 7 + ". ") * (n // 37)
        began = time.time()
        list(chunking.recursive_spans(text, 800, 150, chunking.SEPARATORS))
        took.append(time.time() - began)
    assert took[1] < 12 * max(took[0], 0.02)


def docs(spark, *texts):
    rows = [(f"u{i}", f"t{i}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "url string, title string, content string")


def test_recursive_rows_and_size_filter(spark):
    text = "a" * 60 + "\n\n" + "b" * 10 + "\n\n" + "c" * 60
    df = docs(spark, text, "", "   ", "d" * 49, "e" * 50, "f" * 51)
    pieces_ = chunking.recursive_chunks(df, size=62, overlap=0)
    chunks = chunking.finish_chunks(pieces_).orderBy("url", "chunk_index").collect()
    assert [(c.url, c.chunk_index, len(c.chunk_text)) for c in chunks] == [
        ("u0", 0, 60), ("u0", 2, 60), ("u4", 0, 50), ("u5", 0, 51)
    ]
    assert chunks[0].title == "t0"


def test_recursive_plan_has_no_shuffle(spark):
    plan = chunking.finish_chunks(chunking.recursive_chunks(docs(spark, "a")))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 150, 151, 800, 801, 950, 951, 1450, 1451, 5000])
def test_fixed_windows(spark, n):
    text = "".join(chr(97 + i % 26) if i % 7 else "😀" for i in range(n))
    got = [r.chunk_text for r in chunking.fixed_chunks(docs(spark, text)).orderBy("chunk_index").collect()]
    starts = range(0, max(n - 150 - 1, 0) + 1, 650) if n else []
    assert got == [text[s:s + 800] for s in starts]


def test_fixed_windows_of_a_long_text(spark):
    df = spark.range(1).select(F.lit("u").alias("url"), F.lit("t").alias("title"), F.repeat(F.lit("abcdefghij"), 500_000).alias("content"))
    began = time.time()
    assert chunking.fixed_chunks(df).count() == (5_000_000 - 151) // 650 + 1
    assert time.time() - began < 30


def test_token_windows(spark):
    text = " ".join(str(i) for i in range(25))
    rows = chunking.token_chunks(docs(spark, text, " a\t b\n"), size=10, overlap=3).orderBy("url", "chunk_index").collect()
    assert [r.chunk_text for r in rows] == [
        " ".join(map(str, range(s, min(s + 10, 25)))) for s in (0, 7, 14, 21)
    ] + ["a b"]


def test_sections_keep_code_whole(spark):
    text = "intro\n# A\nx\n```\n## not a heading\n```\ny\n## B\n#### deep\n#no\n```\n# open to the end"
    rows = chunking.section_chunks(docs(spark, text)).orderBy("chunk_index").collect()
    assert [(r.heading, r.chunk_text) for r in rows] == [
        (None, "intro"),
        ("A", "# A\nx\n```\n## not a heading\n```\ny"),
        ("B", "## B\n#### deep\n#no\n```\n# open to the end"),
    ]


def test_oversize_sections_are_split_further(spark):
    df = docs(spark, "# A\n" + "word " * 300 + "\n# B\nshort")
    rows = chunking.section_then_recursive_chunks(df, size=200, overlap=20).collect()
    assert max(len(r.chunk_text) for r in rows) <= 200
    assert {r.heading for r in rows} == {"A", "B"} and sum(r.heading == "B" for r in rows) == 1
    assert [r.chunk_index for r in rows] == list(range(len(rows)))
    assert [r.section for r in rows] == [0] * (len(rows) - 1) + [1]
    plain = chunking.section_chunks(df)
    long = chunking.section_then_recursive_chunks(df, size=100_000, overlap=20)
    assert [r.chunk_text for r in long.collect()] == [r.chunk_text for r in plain.collect()]
    sized = ingest.silver_from_bronze(df, "markdown_header", size=200, overlap=20)
    assert {r.chunk_index for r in sized.collect()} <= set(range(len(rows)))


def test_a_run_without_separators_is_cut_by_arithmetic():
    spans = list(chunking.recursive_spans("x" * 3_000_000, 800, 150, chunking.SEPARATORS))
    assert spans[:2] == [(0, 800), (650, 1450)] and spans[-1][1] == 3_000_000
    assert all(b - a == 800 for a, b in spans[:-1]) and spans[-1][1] - spans[-1][0] > 150
    assert list(chunking.recursive_spans("abc", 1, 0, ("",))) == [(0, 1), (1, 2), (2, 3)]


def test_measured_chunks_keep_their_size_and_rejoin(spark):
    import random

    rng = random.Random(4)
    texts = ["".join(rng.choices(["word", "x", " ", "  ", "\n", "\n\n", ". ", "é", "中"], k=rng.randint(0, 300))) for _ in range(60)] + [None, "", "   ", "a" * 1000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "url int, content string, n_tokens int")

    def fours(text):  # tokens of four characters
        return list(range(0, len(text), 4))

    for tokens, size, overlap in ((chunking.plain_tokens, 12, 0), (fours, 10, 0), (fours, 1, 0), (chunking.plain_tokens, 12, 3)):
        chunks = chunking.measured_chunks(df, keep=["url"], size=size, overlap=overlap, tokens=tokens).collect()
        for i, text in enumerate(texts):
            own = sorted((c.chunk_index, c.n_tokens, c.chunk_text) for c in chunks if c.url == i)
            assert [c[0] for c in own] == list(range(len(own))) and all(0 < c[1] <= size for c in own)
            n = len(tokens(text or ""))
            assert sum(c[1] for c in own) == n + overlap * max(0, len(own) - 1)
            if not overlap:
                assert "".join(c[2] for c in own) == (text if n else "")


def test_measured_chunks_take_linear_time():
    import time

    text = (" " * 400_000 + "x") * 2
    began = time.time()
    spans = list(chunking.measured_spans(text, list(range(0, len(text), 4)), 100, 0))
    assert spans[-1][1] == len(text) and time.time() - began < 20


def test_measured_chunks_prefer_coarse_cuts(spark):
    text = "one two three. four five\nsix seven\n\neight nine ten eleven twelve"
    df = spark.createDataFrame([("u", text)], "url string, content string")
    assert [r.chunk_text for r in chunking.measured_chunks(df, keep=["url"], size=8).collect()] == ["one two three. four five\nsix seven\n\n", "eight nine ten eleven twelve"]
    assert chunking.measured_chunks(df, keep=["url"], size=6).first().chunk_text == "one two three. four five\n"


def test_a_large_batch_leaves_in_portions(spark):
    import pyarrow as pa

    class Batches:
        def __init__(self, df):
            self.df = df

        def select(self, *columns):
            return Batches(self.df.select(*columns))

        def drop(self, *columns):
            return Batches(self.df.drop(*columns))

        schema = property(lambda self: self.df.schema)

        def mapInArrow(self, run, schema):
            return run

    texts = ["word and more words. " * 3000 for _ in range(400)]
    empty = Batches(spark.createDataFrame([], "url string, content string"))
    plain = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(400)]), pa.array(texts)], names=["url", "content"])
    nested = pa.RecordBatch.from_arrays([plain.column(0), pa.array([[t] for t in texts])], names=["url", "_sections"])
    for run, batch in ((chunking.recursive_chunks(empty, keep=["url"]), plain), (chunking.section_then_recursive_chunks(empty, keep=["url"]), nested)):
        sent = list(run(iter([batch])))
        assert max(sum(len(t) for t in b.column("chunk_text").to_pylist()) for b in sent) < 2 * chunking.PORTION_BYTES
        assert len({u for b in sent for u in b.column("url").to_pylist()}) == 400
