"""Compare every registered query with its SQL: python tests/compare.py [sf] [names..]."""

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


def differences(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), None
    done = con.execute(sql)
    columns = [d[0] for d in done.description]
    want_columns, want = rows_of(columns, done.fetchall())
    if got_columns != want_columns:
        return len(got), f"columns {got_columns} and {want_columns}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:3]
        only_want = sorted(set(want) - set(got))[:3]
        return len(got), f"{len(got)} and {len(want)} rows; only Spark {only_got}; only SQL {only_want}"
    return len(got), ""


if __name__ == "__main__":
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(f"/root/testdata/sf{sf}"), e.oracle_sql()
    bad = 0
    for name, query in e.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            n, diff = differences(spark, con, f"/root/testdata/sf{sf}", query, sqls.get(name))
        except Exception as x:  # noqa: BLE001
            n, diff = -1, f"{type(x).__name__}: {str(x)[:1500]}"
        state = "rows only" if diff is None else "ok" if not diff else "DIFF " + diff
        bad += bool(diff)
        print(f"{name:28s} {n:7d} {time.time() - began:6.1f}s  {state}", flush=True)
    print("bad:", bad)
