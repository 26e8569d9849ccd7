"""The bucketed store against a dictionary that follows the same rules."""

import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import store


def test_batches_follow_the_rules(spark, tmp_path):
    path, rng = str(tmp_path / "store"), random.Random(3)
    versions, rows = {}, {}
    batches = []
    for number in range(6):
        keys = [f"k{i}" for i in rng.sample(range(30), 12)] + ([None] if number % 2 else [])
        batch = {k: (rng.randrange(4), [f"{number}-{j}" for j in range(rng.randrange(3))]) for k in keys}
        batches.append(batch)
        for k, (version, own) in batch.items():
            if version >= versions.get(k, -1):
                versions[k], rows[k] = version, own
        again = [(number, batch)] + ([(rng.randrange(number), batches[0])] if number else [])
        for at, b in again:  # an old number again changes nothing
            keyed = spark.createDataFrame([(k, v) for k, (v, _) in b.items()], "url string, version int")
            made = spark.createDataFrame([(k, t, 1, "x") for k, (_, own) in b.items() for t in own], "url string, text string, version int, row string")
            store.merge_batch(spark, path, keyed, made, at, buckets=5)
        found = sorted((r.url or "", r.text) for r in store.stored_rows(spark, path).collect())
        assert found == sorted((k or "", t) for k, own in rows.items() for t in own)
    assert store.stored_rows(spark, path).columns == ["url", "text", "version", "row"]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = tmp_path / "store"
    every = spark.range(100).select(F.col("id").cast("string").alias("url"), F.lit(0).alias("version"))
    store.merge_batch(spark, str(path), every, every.select("url"), 0, buckets=8)
    before = {p.name: sorted(f.name for f in p.glob("part-*")) for p in path.glob("bucket=*")}
    one = every.where("url = '7'")
    store.merge_batch(spark, str(path), one, one.select("url"), 1, buckets=8)
    after = {p.name: sorted(f.name for f in p.glob("part-*")) for p in path.glob("bucket=*")}
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert store.stored_rows(spark, str(path)).count() == 100
    store.merge_batch(spark, str(path), every.limit(0), every.select("url").limit(0), 2, buckets=8)


def test_no_rows_are_made_for_keys_that_are_turned_away(spark, tmp_path):
    path, asked = str(tmp_path / "store"), []

    def made(taken):
        asked.append(sorted((r.url or "", r.version) for r in taken.collect()))
        return taken.select("url", F.concat("url", F.lit("!")).alias("text"))

    def merge(versions, batch):
        keys = spark.createDataFrame(list(versions.items()), "url string, version long")
        store.merge_batch(spark, path, keys, made, batch, buckets=1)

    merge({"a": 5, "b": 1, None: 3}, 0)
    merge({"a": 4, "b": 2, None: 2, "c": 1}, 1)  # a and the null key come late
    merge({"a": 9, "b": 9}, 1)  # the batch has been taken in
    assert asked == [[("", 3), ("a", 5), ("b", 1)], [("b", 2), ("c", 1)]]
    assert sorted((r.url or "", r.text or "") for r in store.stored_rows(spark, path).collect()) == [("", ""), ("a", "a!"), ("b", "b!"), ("c", "c!")]

    @F.udf("string")
    def fails(text):
        raise ValueError("made again")

    keys = spark.createDataFrame([("b", 2)], "url string, version long")
    store.merge_batch(spark, path, keys, keys.select("url", fails("url").alias("text")), 1, buckets=1)


@pytest.mark.parametrize("version", ["v", None])
def test_one_row_of_each_key(spark, version):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (2, None, "c"), (None, 5, "d")], "k int, v int, t string").repartition(3)
    kept = {r.k: r.t for r in store.newest_of_each(df, "k", version).collect()}
    assert set(kept) == {1, 2, None} and (version is None or kept == {1: "b", 2: "c", None: "d"})
