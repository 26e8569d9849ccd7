"""Nothing is lost without a word: odd vectors, null columns, late versions, missing answers."""

import pytest
from pyspark.sql import functions as F

from gleanery import session
from gleanery.operators import sync, vector_search
from gleanery.plans import assess
from gleanery.streaming import jobs


def test_odd_vectors_do_not_hide_others(spark):
    rows = [(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [0.9, 0.1]), (4, None), (5, [float("inf"), 0.0]), (6, [0.0, 0.0]), (7, [None, 1.0])]
    corpus = spark.createDataFrame(rows, "id long, v array<float>")
    queries = spark.createDataFrame([(10, [1.0, 0.0])], "id long, v array<float>")
    for k in (1, 2):
        hits = vector_search.exact_search(queries, corpus, k, "id", "v", "id", "v").collect()
        assert [r.item_id for r in sorted(hits, key=lambda r: r["rank"])] == [1, 3][:k]
    (row,) = vector_search.search_coverage(corpus, "v").collect()
    assert (row.n_rows, row.null_vectors, row.non_finite_vectors, row.zero_vectors, row.searchable) == (7, 1, 3, 1, 2)


def test_any_column_is_a_change(spark):
    schema = "chunk_id string, title string, chunk_text string"
    old = spark.createDataFrame([("1", "a", None), ("2", "t", "x"), ("3", None, None)], schema)
    new = spark.createDataFrame([("1", None, "a"), ("2", "u", "x"), ("3", None, None)], schema)
    got = {r.chunk_id: r.change_type for r in sync.snapshot_diff(old, new, keep_same=True).collect()}
    assert got == {"1": "update", "2": "update", "3": "same"}
    _, table = sync.refresh(old, new)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, new.collect()))


def test_late_versions_and_removed_pages(spark, tmp_path):
    schema = "url string, text string, version long, gone boolean"
    batches = [[("a", "a3", 3, False), ("b", "b1", 1, False)], [("a", "a1", 1, False), ("b", "b2", 2, None)], [("c", "c1", 1, None), ("b", None, 3, True)]]

    def to_chunks(pages):
        return pages.select("url", F.lit(0).alias("chunk_index"), F.col("text").alias("chunk_text"))

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = jobs.read_file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
        query = jobs.sync_corpus(stream, to_chunks, str(tmp_path / "store"), str(tmp_path / "check"), newest_by="version", removed="gone")
        query.awaitTermination()
        if i == 1:
            assert {r.chunk_text for r in jobs.current_chunks(spark, str(tmp_path / "store")).collect()} == {"a3", "b2"}
    assert {r.chunk_text for r in jobs.current_chunks(spark, str(tmp_path / "store")).collect()} == {"a3", "c1"}
    jobs.compact(spark, str(tmp_path / "store"), str(tmp_path / "small"))
    assert {r.chunk_text for r in jobs.current_chunks(spark, str(tmp_path / "small")).collect()} == {"a3", "c1"}


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session, "x")


def test_unanswered_questions_count(spark):
    golden = spark.createDataFrame([("q1", "red fox", ["u"]), ("q2", "blue sky", ["w"])], "query_id string, expected_response string, expected_urls array<string>")
    hits = spark.createDataFrame([("q1", 1, "u", 0.9)], "query_id string, rank int, url string, score double")
    answers = spark.createDataFrame([("q1", "red fox", "red fox", 1.0)], "query_id string, answer string, context string, latency_s double")
    row = assess.assess(golden, hits, answers).head()
    assert row.correctness_mean == 0.5 and row.relevance_mean == 0.5
