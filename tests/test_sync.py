from pyspark.sql import functions as F
import pytest

from gleanery.operators import monitor, sync

KIND = "chunk_id string, chunk_text string"


def snapshots(spark):
    old = spark.createDataFrame([("same", "a"), ("changed", "b"), ("gone", "c")], KIND)
    new = spark.createDataFrame([("same", "a"), ("changed", "B"), ("fresh", "d")], KIND)
    return old, new


def test_diff(spark):
    diff = sync.snapshot_diff(*snapshots(spark), keep_same=True)
    assert {tuple(r) for r in diff.collect()} == {
        ("same", "same"), ("changed", "update"), ("gone", "delete"), ("fresh", "insert")
    }


def test_refresh(spark):
    old, new = snapshots(spark)
    changes, table = sync.refresh(old, new)
    assert {(r.chunk_id, r.change_type, r.chunk_text) for r in changes.collect()} == {
        ("changed", "update", "B"), ("gone", "delete", None), ("fresh", "insert", "d")
    }
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, new.collect()))


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_refresh_of_many_rows(spark, monkeypatch, words):
    monkeypatch.setattr(sync, "MOST_WORDS", words)  # one word: all its bits are set, and nothing is filtered
    old = spark.range(3000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    old = old.unionByName(spark.createDataFrame([(None, "none")], "k int, t string"))
    new = spark.range(30, 3100).select(F.col("id").alias("k"), F.when(F.pmod("id", F.lit(9)) == 0, "new").otherwise(F.concat(F.lit("t"), "id")).alias("t"))
    changes, table = sync.refresh(old, new, "k")
    want = {i: "new" if i % 9 == 0 else f"t{i}" for i in range(30, 3100)}
    rows = [tuple(r) for r in table.collect()]
    assert len(rows) == len(want) + 1 and dict(rows) == want | {None: "none"}
    found = {r.k: r.change_type for r in changes.where("k IS NOT NULL").collect()}
    assert found == {i: "delete" for i in range(30)} | {i: "update" for i in range(36, 3000, 9)} | {i: "insert" for i in range(3000, 3100)}


def test_rows_without_keys_pass_no_shuffle(spark):
    df = spark.createDataFrame([(i % 500, f"t{i}") for i in range(1000)] + [(None, "none")], "k long, t string")
    keys = spark.createDataFrame([(i,) for i in [*range(0, 600, 50), 0, 0]] + [(None,)], "k int")
    rows = sync.without_keys(df, keys, "k").collect()
    assert sorted(r.t for r in rows) == sorted(["none", *(f"t{i}" for i in range(1000) if i % 50)])
    assert sync.KeyFilter(keys, "k").rows(df, True).count() < 200
    assert sync.without_keys(df, keys.limit(0), "k").count() == 1001


def test_rows_that_stay_are_not_shuffled(spark, monkeypatch):
    many = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    few = many.withColumn("t", F.when(F.col("k") < 40, "new").otherwise(F.col("t")))
    joined, one = [], sync.change_rows
    monkeypatch.setattr(sync, "change_rows", lambda changes, new, key: joined.append(new.count()) or one(changes, new, key))
    sync.refresh(many, few, "k")
    assert 40 <= joined[0] < 1000


def test_keys_of_changes_are_counted_as_they_are_written(spark, monkeypatch):
    counted, one, tables = [], type(spark.range(1)).count, []
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: counted.append(self.columns) or one(self))
    write = sync.written_counted
    monkeypatch.setattr(sync, "written_counted", lambda *a: tables.append(write(*a)) or tables[-1])
    old, new = snapshots(spark)
    odd = [(None, "x"), ("twice", "a"), ("twice", "a"), ("none", None)]
    old, new = old.unionByName(spark.createDataFrame(odd[:3], KIND)), new.unionByName(spark.createDataFrame(odd[1:], KIND))
    changes, table = sync.refresh(old, new)
    assert counted == []
    assert [n for _, n in tables] == [5] and len(tables[0][0].collect()) == 5
    assert {tuple(r[c] for c in ("chunk_id", "change_type", "chunk_text")) for r in changes.collect()} == {
        ("changed", "update", "B"), ("gone", "delete", None), ("fresh", "insert", "d"), (None, "delete", None), ("none", "insert", None)
    }
    key = lambda r: str(tuple(r))
    assert sorted(map(key, table.collect())) == sorted(map(key, [*new.collect(), (None, "x")]))  # a null key is never the same key
    empty = spark.createDataFrame([], KIND)
    changes, table = sync.refresh(empty, empty)
    assert changes.collect() == table.collect() == [] and tables[-1][1] == 0


def test_a_repeated_key_does_not_multiply(spark):
    old = spark.createDataFrame([("k", "a")] * 500, KIND)
    new = spark.createDataFrame([("k", "a")] * 500, KIND)
    assert sync.snapshot_diff(old, new, keep_same=True).collect() == [("k", "same")]


def test_reconcile(spark):
    a, b = spark.range(0, 10), spark.range(4, 12)
    row = sync.reconcile(a, b, "id", "id").first()
    assert tuple(row) == (10, 8, 2, 4, 2)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "chunk_id string")
    assert [tuple(r) for r in monitor.duplicate_keys(df).collect()] == [("a", 2)]
    assert tuple(monitor.duplicate_key_count(df).first()) == (3, 2, 1)


def test_a_new_column_is_a_change(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "chunk_id string, chunk_text string")
    new = spark.createDataFrame([("a", "x", None), ("b", "y", "en")], "chunk_id string, chunk_text string, lang string")
    assert [tuple(r) for r in sync.snapshot_diff(old, new).collect()] == [("b", "update")]
    assert [tuple(r) for r in sync.snapshot_diff(new, old).collect()] == [("b", "update")]
