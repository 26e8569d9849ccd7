from pyspark.sql import functions as F
from pyspark.sql import types as T
import pytest

from gleanery.plans import ingest
from gleanery.sources import catalog, files, tables


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "en__guide__index.html").write_text(
        "<body><nav>x</nav><h1>Guide</h1><p>" + "word " * 300 + "</p></body>", encoding="utf-8")
    (tmp_path / "notes.a.md").write_bytes(b"# Notes\nkeep _this_ a\xffb \xc3\xa9 " + b"text " * 20)
    (tmp_path / "empty.html").write_text("<nav>only</nav>")
    (tmp_path / "X.HTML").write_text("<p>skipped</p>")
    (tmp_path / "a b+c%20é.htm").write_text("<p>named</p>", encoding="utf-8")
    (tmp_path / "data.json").write_text("{}")
    return str(tmp_path)


def test_page_files(spark, folder):
    rows = {r.file_name: r for r in files.read_page_files(spark, folder).collect()}
    assert set(rows) == {"en__guide__index.html", "notes.a.md", "empty.html", "a b+c%20é.htm"}
    assert rows["notes.a.md"].raw.startswith("# Notes\nkeep _this_ ab é text")
    assert not rows["notes.a.md"].is_html and rows["empty.html"].is_html


def test_decoding_drops_only_bad_bytes(spark):
    values = [b"a\xffb", "ok �é".encode(), b"\xe2\x82A", b"", None, b"\xf0\x9f\x98\x80\xf0\x9f"]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, v binary")
    got = [r.t for r in df.select("i", files.decode_utf8("v").alias("t")).orderBy("i").collect()]
    assert got == [None if v is None else v.decode("utf-8", "ignore") for v in values]


def test_bronze(spark, folder):
    rows = {r.url: r for r in ingest.bronze_from_files(spark, folder, "https://h/").collect()}
    assert set(rows) == {"https://h/en/guide/index", "https://h/notes.a", "https://h/a b+c%20é"}
    assert rows["https://h/en/guide/index"].title == "Guide"
    assert rows["https://h/notes.a"].title == "Notes" and "_this_" in rows["https://h/notes.a"].content


def test_ingestion(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    counts = ingest.run_ingestion(spark, folder, "https://h/", f"{out}/bronze", f"{out}/silver")
    silver = spark.read.parquet(f"{out}/silver")
    assert counts == {"documents": 3, "chunks": silver.count()}
    assert [f.name for f in silver.schema] == [f.name for f in tables.SILVER]
    assert [f.dataType for f in silver.schema] == [f.dataType for f in tables.SILVER]
    assert [f.dataType for f in spark.read.parquet(f"{out}/bronze").schema] == [f.dataType for f in tables.BRONZE]
    assert silver.select("chunk_id").distinct().count() == silver.count() > 2


@pytest.mark.parametrize("strategy", ["recursive_character", "markdown_header", "token_based", "fixed"])
def test_strategies(spark, strategy):
    bronze = spark.createDataFrame([("u", "t", "# Head\n" + "some words here. " * 100)], "url string, title string, content string")
    silver = ingest.silver_from_bronze(bronze, strategy)
    assert silver.count() >= 1 and silver.columns == [f.name for f in tables.SILVER]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown strategy"):
        ingest.silver_from_bronze(spark.createDataFrame([], tables.BRONZE), "other")


def test_write_is_repeatable_partitioned_and_counted(spark, tmp_path):
    df = spark.createDataFrame([(1, "en"), (2, "fr"), (3, "en")], "i int, lang string")
    path = f"{tmp_path}/t"
    assert tables.write_table(df, path, ["lang"], count_rows=True) == 3
    assert tables.write_table(df.where("i < 3"), path, ["lang"], count_rows=True) == 2
    back = spark.read.parquet(path).where("lang = 'en'")
    assert [r.i for r in back.collect()] == [1]
    assert "PartitionFilters: [isnotnull(lang" in back._jdf.queryExecution().executedPlan().toString()


def test_log_whose_schema_grows(spark, tmp_path):
    path = f"{tmp_path}/log"
    spark.createDataFrame([("r0",)], "request_id string").write.parquet(path)
    young = tables.read_log(spark, path)
    assert tables.newest_rows(young, 5).count() == 1
    full = T.StructType([T.StructField("request_id", T.StringType()), T.StructField("timestamp_ms", T.LongType()), T.StructField("response", T.StringType())])
    assert tables.with_columns_present(young, full).columns == full.names
    rows = [(f"r{i}", i, "x") for i in range(1, 9)]
    spark.createDataFrame(rows, full).write.mode("append").parquet(path)
    newest = tables.newest_rows(tables.read_log(spark, path), 5, tie="request_id")
    assert [r.request_id for r in newest.collect()] == ["r8", "r7", "r6", "r5", "r4"]
    assert "TakeOrderedAndProject" in newest._jdf.queryExecution().executedPlan().toString()


def test_preview_and_golden_set(spark):
    golden = tables.golden_set(spark, [("q2", "a", ["u"]), ("q1", None, [])])
    assert [r.request for r in tables.preview(golden, 1, "request").collect()] == ["q1"]
    assert golden.where(F.size("expected_urls") == 1).count() == 1


def test_tables_by_name(spark, tmp_path):
    schema = T.StructType([T.StructField("url", T.StringType(), False), T.StructField("n", T.IntegerType())])
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "n long, URL string, lang string")
    catalog.create_table(rows, "by_name", schema, str(tmp_path / "t"), ["lang"])
    try:
        assert [(f.name, f.dataType.simpleString()) for f in spark.table("by_name").schema] == [("url", "string"), ("n", "int"), ("lang", "string")]
        catalog.append_table(spark.createDataFrame([("c", "z", 0.5)], "url string, lang string, score double"), "by_name", schema)
        found = sorted((r.url, r.n, r.lang, r.score) for r in spark.table("by_name").collect())
        assert found == [("a", 1, "x", None), ("b", 2, "y", None), ("c", None, "z", 0.5)]
        with pytest.raises(Exception, match="column url must not be null"):
            catalog.append_table(spark.createDataFrame([(None, 1)], "url string, n int"), "by_name", schema)
        with pytest.raises(ValueError, match="url"):
            catalog.append_table(spark.createDataFrame([(1,)], "n int"), "by_name", schema)
        assert spark.table("by_name").count() == 3
    finally:
        catalog.drop_table(spark, "by_name")
    assert not spark.catalog.tableExists("by_name")
