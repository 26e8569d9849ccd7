"""HTML extraction, WARC and BPE: exact round trips, edge cases, brute force."""

import gzip
import hashlib
import io
import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F
import tiktoken

from gleanery.llm import bpe, html_diff, queries, warc

PAGES = "page_id long, url string, html string, text string, `Part` int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 1) for i, u, h in rows], PAGES)


def text_of(df):
    return {r.page_id: r.text for r in html_diff.extract(df).collect()}


def test_article_is_taken_whole(spark):
    page = (
        '<!doctype html><head><title>no</title><style>p{}</style></head><body><nav><ul><li>Menu</ul></nav><header><h1>Site</h1></header>'
        '<article><header><h1>T &amp; U</h1></header><p>One&nbsp; <b>two</b>\n three<p>four<div class="comments"><p>me too</div><footer>by</footer></article>'
        '<div id="cookie-notice">ok?</div><form><p>mail</form><footer>&copy; x</footer><script>var a="<p>x</p>"</script>'
    )
    df = pages(spark, [(1, "http://h/a/1", page), (2, "http://h/a/2", page.replace("four", "five")), (3, None, None), (4, "", ""), (None, "x", page), (1, "http://h/a/1", page)])
    rows = html_diff.extract(df).collect()
    assert len(rows) == 6
    got = {r.page_id: r.text for r in rows}
    assert got == {1: "T & U\nOne two three\nfour", 2: "T & U\nOne two three\nfive", 3: "", 4: "", None: "T & U\nOne two three\nfour"}
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_diff.extract(df.limit(0)).count() == 0


def test_pages_without_a_root_lose_what_neighbours_share(spark):
    rows = [(i, f"https://host/news/{i:03d}", f"<body><div>Our site</div><div>Home - News</div><p>Story {i} begins.</p><p>Story {i} ends.</p><div>Read more on our site</div></body>") for i in range(30)]
    rows += [(100, "https://host/news/015?copy", rows[15][2])]  # a copy beside its original
    rows += [(200, "https://alone/x", "<div>Our site</div><p>Alone</p>")]
    got = text_of(pages(spark, rows).repartition(3))
    for i in range(30):
        assert got[i] == f"Story {i} begins.\nStory {i} ends."
    assert got[100] == got[15] and got[200] == "Our site\nAlone"


@pytest.mark.parametrize("copies", [3, 1000])
def test_copies_of_a_page_do_not_delete_its_text(spark, copies):
    def page(i, menu):
        return f"<body><nav>{menu}</nav><div>Our site</div><div>Home - News</div><p>Story {i} begins.</p><p>Story {i} goes on.</p><p>Story {i} ends.</p><div>Read more</div></body>"

    rows = [(i, f"https://host/news/{i:03d}", page(i, "Menu")) for i in range(20)]
    rows += [(1000 + n, f"https://host/news/010?ref={n}", page(10, f"Menu {n}" * (n % 2))) for n in range(copies)]
    rows += [(9000 + n, f"https://mirror/a?ref={n}", page("M", "Menu")) for n in range(copies)]  # nothing but copies on this host
    got = text_of(pages(spark, rows).repartition(3))
    text = "Story {0} begins.\nStory {0} goes on.\nStory {0} ends."
    assert all(got[i] == text.format(i) for i in range(20))
    assert {got[1000 + n] for n in range(copies)} == {text.format(10)}
    assert all(text.format("M") in got[9000 + n] for n in range(copies))


def test_site_lines_inside_an_article_go_and_quotes_stay(spark):
    def page(i, *more):
        told = "".join(f"<p>Story {i}, part {n}.</p>" for n in range(4))
        return f"<article><h1>Title {i}</h1>{told}{''.join(f'<p>{m}</p>' for m in more)}<div>Read more</div><div>About the author</div></article>"

    quotes = {i: ["A passage that is quoted."] for i in (7, 8, 9)}
    rows = [(i, f"http://host/news/{i:03d}", page(i, *quotes.get(i, []))) for i in range(40)]
    # a run of near copies: most of what page 20 stands among, but one vote
    rows += [(100 + n, f"http://host/news/020-{n:02d}", page(20, f"Printed {n}")) for n in range(30)]
    rows += [(200 + i, f"http://two/{i}", page(i)) for i in range(2)]  # too few to tell
    got = text_of(pages(spark, rows).repartition(3))
    text = lambda i, *more: "\n".join([f"Title {i}", *(f"Story {i}, part {n}." for n in range(4)), *more])
    for i in range(40):
        assert got[i] == text(i, *quotes.get(i, [])), i
    assert all(got[100 + n].startswith(text(20, f"Printed {n}")) for n in range(30))
    assert got[200] == text(0, "Read more", "About the author")


def test_pairs_do_not_depend_on_blocks_or_partitions(spark, sf_dir, monkeypatch):
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {bytes(r.page_key): r.shared for r in html_diff.shared_lines(html_diff._keyed(df, "page_id", "url", "html")).collect()}
    monkeypatch.setattr(html_diff, "BLOCK", 9)
    got = {bytes(r.page_key): r.shared for r in html_diff.shared_lines(html_diff._keyed(df.repartition(5), "page_id", "url", "html")).collect()}
    assert got == want and any(want.values())


def test_query_gives_the_articles(spark, sf_dir):
    import html
    import re

    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op2_html_extraction(spark, sf_dir).collect():
        article = source[r.page_id].split("<article>")[1].split("</article>")[0]
        lines = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1|br|b)>", article)]
        assert r.text == "\n".join(x for x in lines if x)


def lcs_length(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_lines_are_longest():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        found = html_diff.common_lines(a, b)
        assert len(found) == lcs_length(a, b) and found == sorted(set(found))
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_common_lines_by_bits_are_longest(monkeypatch):
    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 25))] for _ in range(2))
        monkeypatch.setattr(html_diff, "BIT_TABLE", rng.choice([0, 5, 1 << 20]))
        found = html_diff._common_by_bits(a, b)
        assert len(found) == lcs_length(a, b) and found == sorted(set(found))
        rest = iter(b)
        assert all(a[i] in rest for i in found)
    monkeypatch.undo()
    began = time.time()
    a, b = ([0 if i % 2 else sign * i for i in range(20_000)] for sign in (1, -1))
    assert len(html_diff.common_lines(a, b)) == 10_001
    assert time.time() - began < 10


def test_names_inside_an_article_need_a_neighbour(spark):
    def page(i, inner):
        return f"<article><h1>T {i}</h1><p>Text {i}.</p>{inner}</article>"

    named = ["<div class='comment-on-law'><p>body</p></div>", "<section id='related-work'><h2>ad</h2><p>more</p></section>", "<div class='notice-of-death'>gone</div>"]
    rows = [(i, f"http://law/{i:02d}", page(i, "")) for i in range(9)]
    rows += [(20 + i, f"http://law/04-{i}", page(20 + i, x)) for i, x in enumerate(named)]
    rows += [(100 + i, f"http://blog/{i:02d}", page(i, f"<div class='comments'><p>me too {i}</p></div><p>End {i}.</p>")) for i in range(9)]
    got = text_of(pages(spark, rows))
    assert [got[20 + i].split("\n", 2)[2] for i in range(3)] == ["body", "ad\nmore", "gone"]
    assert all(got[100 + i] == f"T {i}\nText {i}.\nEnd {i}." for i in range(9))
    assert html_diff.main_text("<article>Let <math>x</math> be <object>2</object>.</article>", None) == "Let x be 2."


def test_blocks_without_any_names(spark, sf_dir):
    """Tags of the given pages made neutral, classes taken off: their places in the template decide."""
    df = spark.read.parquet(f"{sf_dir}/pages.parquet")
    named = text_of(df)
    neutral = df.withColumn("html", F.regexp_replace(F.regexp_replace("html", r"(</?)(article|nav|footer)\b", "$1div"), ' class="[^"]*"', ""))
    hosts = df.groupBy(html_diff.host_and_path(F.col("url"))[0].alias("h")).agg(F.collect_list("page_id").alias("ids")).where(F.size("ids") > 2)
    many = {i for r in hosts.collect() for i in r.ids}
    got = {i: t for i, t in text_of(neutral).items() if i in many}
    assert got and sum(named[i] == t for i, t in got.items()) >= 0.9 * len(got)


def test_bytes_that_are_no_text(spark):
    df = spark.sql("select 1L as page_id, cast(x'687474703A2F2FFF2F' as string) as url, cast(x'3C703E61FF623C2F703E' as string) as html")
    assert [r.text for r in html_diff.extract(df).collect()] == ["a\ufffdb"]


def test_depth_takes_no_room():
    import tracemalloc

    tracemalloc.start()
    html_diff.read_page("<form><div>x" * 12_000)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_broken_and_deep_markup():
    read = lambda s: html_diff.main_text(s, None)
    assert read("<p>a<![foo[x]]>b<![ bad") == "ab"
    assert read("<div>" * 700 + "<main>in</main>" + "</div>" * 700 + "<p>out</p>") == "in"
    assert read("<article>A <article>B</article> C</article>") == "A\nB\nC"
    assert read("a < b & c") == "a < b & c" and read('<p title="x>y') == "y"
    assert read("<div class='sidebar'>s</div><p>readable</p>") == "readable"
    for piece in ("<svg>", '<a "', "</b", "<", "<![", "<p>", " ", '<div class="x'):
        began = time.time()
        read(piece * 50_000)
        assert time.time() - began < 5, piece


@pytest.mark.parametrize("wrapper", [
    "<div class='layout with-sidebar'><article>", "<div class='no-sidebar'><article>", "<div class='header-fixed'><article>",
    "<div id='contentWithoutComments'><main>", "<article class='post comments-open'>", "<div class='has-nav'><div class='nav-open'><article>",
])
def test_a_state_or_wrapper_does_not_hide_the_article(wrapper):
    read = lambda s: html_diff.main_text(s, None)
    assert read(f"<nav>Menu</nav>{wrapper}<p>A</p><p>B</p></article></main><div class='sidebar'>s</div>") == "A\nB"


def test_neighbours_decide_where_a_wrapper_holds_the_only_article(spark):
    def page(i, rest=""):
        return f"<div class='page sidebar'><div>Our site</div><nav>Menu {i}</nav><article><p>Story {i}.</p><p>It ends {i}.</p></article><div>Read more</div><div class='sidebar'>s {i}</div></div>{rest}"

    rows = [(i, f"http://host/{i:02d}", page(i)) for i in range(9)]
    assert text_of(pages(spark, rows)) == {i: f"Story {i}.\nIt ends {i}." for i in range(9)}
    read = lambda s: html_diff.main_text(s, None)
    assert read(page(1, "<article>The real one</article>")) == "The real one"  # nothing in doubt
    assert read("<p>Text</p><div class='comments'><article>me too</article></div><div class='related'><article>Tease</article></div>") == "Text"
    assert read("<p>Text</p><nav><article>Tease</article></nav><div hidden class='header'><article>No</article></div>") == "Text"


def test_long_page(spark):
    body = "".join(f"<p>paragraph {i}</p>" for i in range(20_000))
    got = text_of(pages(spark, [(1, "http://h/1", f"<div>site</div>{body}"), (2, "http://h/2", "<div>site</div><p>short</p><p>and sweet</p>")]))
    assert got[1].count("\n") == 19_999 and got[2] == "short\nand sweet"


def test_warc_round_trip(spark):
    big = "é<p>x</p>\r\n\r\nWARC/1.1\r\n" * 9000
    rows = [(1, "http://a/ b", "same"), (2, None, "same"), (9, "u", "same"), (9, "u", "same"), (3, "v", None), (4, "w", ""), (None, "n", "alone"), (5, "x", big), (None, "y", big), (6, "z", "0\r\n\r\n")]
    got = [(r.page_id, r.kind, r.refers_to, r.payload_bytes, r.payload_digest, r.intact) for r in warc.round_trip(pages(spark, rows).repartition(3), segment_bytes=1000).collect()]
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [j for j, _, x in rows if (x or "") == (h or "") and j is not None]
        revisit = bool(ids) and sum((x or "") == (h or "") for *_, x in rows) > 1 and i != max(ids)
        want.append((i, "revisit" if revisit else "response", max(ids) if revisit else None, len(data), warc.digest(data), True))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    payloads = [bytes(r.payload) for r in warc.round_trip(pages(spark, rows), segment_bytes=1000).collect() if r.page_id == 5]
    assert payloads == [big.encode()]
    assert warc.round_trip(pages(spark, rows).limit(0)).count() == 0
    small = warc.round_trip(pages(spark, rows), min_bytes=5).collect()
    assert all(r.kind == "response" for r in small if r.payload_bytes < 5)


def test_revisits_refer_to_records_of_the_archive(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, f"http://a/{i}", ["same", "other", None][i % 3]) for i in range(40)]
    warc.write_archives(pages(spark, rows).repartition(4), str(tmp_path / "w"))
    responses, revisits = {}, 0
    for r in spark.read.format("binaryFile").load(str(tmp_path / "w")).collect():
        for h, _ in warc.parsed(io.BytesIO(r.content)):
            if h["warc-type"] == "response":
                responses[h["warc-record-id"]] = h
    for r in spark.read.format("binaryFile").load(str(tmp_path / "w")).collect():
        for h, _ in warc.parsed(io.BytesIO(r.content)):
            if h["warc-type"] == "revisit":
                target = responses[h["warc-refers-to"]]
                assert target["warc-payload-digest"] == h["warc-payload-digest"]
                assert (target["warc-target-uri"], target["warc-date"]) == (h["warc-refers-to-target-uri"], h["warc-refers-to-date"])
                revisits += 1
    assert revisits > 10 and len(responses) + revisits == 40


def test_a_large_page_is_put_together_in_linear_time(spark):
    big = "<p>0123456789abcdef</p>\n" * 1_300_000  # 30 MB in some 470 segments
    began = time.time()
    [row] = warc.round_trip(pages(spark, [(1, "http://a", big)])).select("payload_bytes", "intact").collect()
    assert tuple(row) == (len(big), True) and time.time() - began < 60


def test_warc_reports_what_is_damaged(spark, tmp_path):
    page = {"page_id": 1, "url": "http://x", "payload": b"abc" * 5000, "refers_to": None, "digest": warc.digest(b"abc" * 5000), "is_revisit": False}
    parts = list(warc.records_of(page, "0-0", 4000))
    assert len(parts) > 3
    end = warc.RECORD_END.encode()

    def read(name, records):
        (tmp_path / name).write_bytes(b"".join(gzip.compress(r + end) for r in records))
        return warc.read_payloads(spark, str(tmp_path / name)).collect()

    assert [r.intact for r in read("shuffled", parts[::-1])] == [True]
    for name, records in {"gap": parts[:1] + parts[2:], "cut": parts[:-1], "twice": [*parts, parts[1]], "headless": parts[1:]}.items():
        assert [r.intact for r in read(name, records)] == [False], name
    other = parts[0].replace(b"sha1:", b"sha1:A")
    assert [r.intact for r in read("digest", [other, *parts[1:]])] == [False]
    assert warc.unframed(warc.framed(b"x" * 20_000, 7)) == b"x" * 20_000
    with pytest.raises(ValueError):
        warc.unframed(b"5\r\nab\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parsed(io.BytesIO(b"no archive\r\n")))


@pytest.fixture(scope="module")
def tokenizer():
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def units():
    return bpe.Encoder(bpe.Transducer(bpe.Compiled(bpe.read_ranks(public_tokenizers.path(bpe.RANKS)))), public_tokenizers.PATTERN)


def test_encoding_is_that_of_the_library(units, tokenizer, sf_dir):
    rng = random.Random(1)
    letters = list("abcdefghinorstu ABE'.,0123\n\t éß漢字😀\xa0́\x1c\x85$%&") + ["<|endoftext|>"]
    for _ in range(4000):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert list(bpe.encode_text(units, s)) == tokenizer.encode_ordinary(s)
    for s in ("a" * 20_000, "thntentionable" * 3000, "你好" * 5000, "  \n \n" * 3000, "the " * 5 + "  x  y", " ", "\n\n a", "don't we'll I'd", "  a 　b"):
        assert list(bpe.encode_text(units, s)) == tokenizer.encode_ordinary(s), s[:20]


def test_bounds_do_not_change_the_result(units, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 50)
    monkeypatch.setattr(bpe, "MOVE_BITS", 10)
    monkeypatch.setattr(bpe, "MOST_PAIRS", 20)
    monkeypatch.setattr(bpe, "LOOKAHEAD", 16)
    fresh = bpe.Encoder(bpe.Transducer(units.transducer.c), public_tokenizers.PATTERN)
    for s in ("internationalization of unbelievable thntentionableness, étrangement " * 30 + "x" * 500, "".join(map(chr, range(33, 3000)))):
        assert list(bpe.encode_text(fresh, s)) == tokenizer.encode_ordinary(s)


def test_moves_are_made_together_and_units_kept(units, tokenizer, monkeypatch):
    def alone(*_):
        raise AssertionError("one by one")

    words = [" ".join(tokenizer.decode([a, b]).replace(" ", "") for a, b in zip(range(n, 50_000, 97), range(49_000, 0, -89))) for n in (300, 350)]
    fresh = bpe.Encoder(bpe.Transducer(units.transducer.c), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe.Transducer, "_move", alone)
    for s in words:
        assert bpe.encode_text(fresh, s).tolist() == tokenizer.encode_ordinary(s)
    monkeypatch.setattr(bpe.Encoder, "found", alone)
    again = " ".join(s for s in reversed(words[0].split(" ")[1:]) if len(s) < 90)
    assert fresh.block([" " + again, " " + again])[1].tolist() == tokenizer.encode_ordinary(" " + again) * 2


def test_kept_units_are_bounded(units, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHARS", 60)
    fresh = bpe.Encoder(bpe.Transducer(units.transducer.c), public_tokenizers.PATTERN)
    for n in range(40):
        s = f"a few words {n} unbelievable {n % 7}" + "thntentionable" * (n % 5)
        assert bpe.encode_text(fresh, s).tolist() == tokenizer.encode_ordinary(s)
        assert fresh.held <= 60 and len(fresh.number) == len(fresh.stops) - 1


def test_blocks_keep_texts_apart(units, tokenizer):
    rng = random.Random(3)
    words = ["the", "cat", "", "\n", "x\n", "don't", "é", " ", "a" * 90, "naïve.", "1st\n\n", "\x85"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(600)] + ["", "", " a"]
    offsets, ids = units.block(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [tokenizer.encode_ordinary(t) for t in texts]
    assert units.block([])[1].tolist() == []


def test_other_patterns(units):
    odd = bpe.Encoder(units.transducer, r"(\p{L})+")  # with a group, and passing over what is no letter
    assert [units.transducer.c.bytes_of[i] for i in bpe.encode_text(odd, "ab 12 cd")] == [b"ab", b"cd"]


@pytest.mark.parametrize("pattern", [r"\p{L}+|[^\s\p{L}]+[\r\n ]*|\s+", r"\p{L}+ ?|[^\p{L}]+"])
def test_patterns_that_run_into_white_space(units, pattern):
    odd, t = bpe.Encoder(units.transducer, pattern), units.transducer
    texts = ["ab, cd.\n\nef", "x ! \r\n y", "one two  three . ", "a" * 200 + " b ,", "", " cd"]
    want = [[i for m in odd.pattern.finditer(s) for i in t.encode(m[0].encode())] for s in texts]
    offsets, ids = odd.block(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_every_token_is_itself(units):
    c = units.transducer.c
    assert all(units.transducer.encode(data) == [rank] for data, rank in list(c.ranks.items())[::7])


def test_streaming_decode(units):
    s = "né漢😀 " * 3000
    ids = bpe.encode_text(units, s).tolist()
    assert bpe.decoded(units.transducer.c.bytes_of, ids, step=1) == s == bpe.decoded(units.transducer.c.bytes_of, ids)
    broken = [units.transducer.c.ranks[b"\xf0"]]
    assert bpe.decoded(units.transducer.c.bytes_of, broken) == "�"


def test_bpe_query(spark, tokenizer, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_bpe(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = tokenizer.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_bpe_edges(spark):
    rows = [(None, "a"), (1, None), (1, None), (2, ""), (3, "word " * 50_000)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, ids int")
    got = queries.bpe_digests(bpe.round_trip(df)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == 5 and sum(r.n_tokens == 0 and r.ids_sha256 == empty == r.decoded_sha256 for r in got) == 3
    assert bpe.encode(df.limit(0)).count() == 0
    back = bpe.decode(bpe.encode(df).withColumn("extra", F.lit("x")))
    assert back.columns == ["doc_id", "extra", "decoded"] and max(len(r.decoded) for r in back.collect()) == 250_000
