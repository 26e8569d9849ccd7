"""Sketches, drift of distributions, stratified samples, the table function."""

from bisect import bisect_left, bisect_right
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from gleanery.functions import sql
from gleanery.operators import distributions
from gleanery.streaming import jobs
from test_streaming import LOG, log


def test_merged_sketches_stay_within_the_error(spark):
    rng = random.Random(2)
    rows = [(i % 7, rng.paretovariate(1.1)) for i in range(40_000)]
    df = spark.createDataFrame(rows, "day int, v double").repartition(6)
    days = df.groupBy("day").agg(distributions.sketch("v", 256).alias("s"))
    [row] = distributions.merged_quantiles(days.where("day <> 3"), "s", {"a": 0.1, "b": 0.5, "c": 0.99}, size=256).collect()
    values = sorted(v for d, v in rows if d != 3)
    for found, p in zip(row, (0.1, 0.5, 0.99), strict=True):
        assert abs(bisect_left(values, found) / len(values) - p) <= distributions.rank_error(256)
    assert distributions.rank_error(1024) < 0.005


def ks_by_hand(a, b):
    a, b = sorted(a), sorted(b)
    return max(abs(bisect_right(a, v) / len(a) - bisect_right(b, v) / len(b)) for v in {*a, *b})


def test_drift_against_a_baseline(spark):
    rng = random.Random(1)
    base = [round(rng.gauss(0, 1), 2) for _ in range(900)] + [0.5] * 500
    days = {"same": [round(rng.gauss(0, 1), 2) for _ in range(300)] + [0.5] * 150, "moved": [round(rng.gauss(1, 1), 2) for _ in range(200)], "few": [-9.0], "high": [9.0, 9.0, None], None: [0.5, 0.1]}
    baseline = spark.createDataFrame([(v, 1) for v in base] + [(None, 1)], "v double, g int").repartition(4)
    current = spark.createDataFrame([(d, v, "x", True) for d, vs in days.items() for v in vs], "g string, v double, part string, base boolean").repartition(5)
    found = {r.g: r.ks for r in distributions.ks_statistic(baseline, current, "v", "g").collect()}
    for day, values in days.items():
        assert found[day] == pytest.approx(ks_by_hand(base, [v for v in values if v is not None]))
    psi = {r.g: r.psi for r in distributions.stability_index(baseline, current, "v", "g").collect()}
    assert set(psi) == set(days) and psi["same"] < 0.1 < 0.25 < psi["moved"]
    empty = baseline.limit(0)
    assert distributions.stability_index(empty, current, "v", "g").collect() == []
    assert distributions.ks_statistic(baseline, current.limit(0), "v", "g").collect() == []


def test_stratified_sample_by_hand(spark):
    rows = [(i, "ab"[i % 3 == 0], (i % 5) * 0.5) for i in range(500)] + [(None, "a", 1.0), (7, None, 1.0), (8, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, s string, w double").repartition(4)
    found = distributions.stratified_sample(df, "id", "s", {"a": 30, None: 1}, F.col("w"), default=10).collect()

    def late(i, w):
        return -math.log((int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16) + 1.0) / (16**13 + 1)) / w

    expected = set()
    for stratum, quota in (("a", 30), ("b", 10), (None, 1)):
        own = [(late(i, w), i) for i, s, w in rows if s == stratum and i is not None and w > 0]
        expected |= {(i, stratum) for _, i in sorted(own)[:quota]}
    assert {(r.id, r.s) for r in found} == expected and len(found) == 41
    heavy = distributions.stratified_sample(df.where("s = 'a'"), "id", "s", {"a": 60}, F.when(F.col("w") > 1.6, 50.0).otherwise(1.0)).collect()
    assert sum(r.w > 1.6 for r in heavy) > 50


def test_windows_are_current_while_open(spark, tmp_path):
    folder, store = f"{tmp_path}/log", f"{tmp_path}/store"
    log(spark, folder, (1, "2024-01-01 01:00:00", 1.0, "no"), (2, "2024-01-01 02:00:00", 3.0, "yes"), (3, "2024-01-02 02:00:00", 5.0, "yes"))

    def run():
        jobs.monitor_store(jobs.read_file_stream(spark, folder, LOG), "ts", "s", F.col("answer") == "no", store, f"{tmp_path}/check").awaitTermination()
        return [(str(r.window_start)[:10], r.requests, r.mean_latency_s, r.is_open) for r in jobs.stored_windows(spark, store).orderBy("window_start").collect()]

    assert run() == [("2024-01-01", 2, 2.0, False), ("2024-01-02", 1, 5.0, True)]
    log(spark, folder, (4, "2024-01-02 03:00:00", 7.0, "no"), (5, "2024-01-03 03:00:00", 2.0, "no"))
    assert run() == [("2024-01-01", 2, 2.0, False), ("2024-01-02", 2, 6.0, False), ("2024-01-03", 1, 2.0, True)]
    assert run()[-1] == ("2024-01-03", 1, 2.0, True)
    assert jobs.stored_windows(spark, store, with_open=False).count() == 2


def test_table_function_checks_its_arguments(spark):
    sql.register(spark)
    assert [tuple(r) for r in spark.sql("SELECT * FROM split_text('aaa bbb ccc', 7, 0)").collect()] == [(0, "aaa bbb"), (1, "ccc")]
    assert spark.sql("SELECT * FROM split_text(CAST(NULL AS STRING))").collect() == []
    for bad in ("split_text(1)", "split_text('a', 5, 5)", "split_text('a', -1)", "split_text('a', 'b')"):
        with pytest.raises(Exception, match="split_text"):
            spark.sql(f"SELECT * FROM {bad}").collect()
