"""Helpers of this subpackage: tables, folds, seeded orders and bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than a space and U+0009 to U+000D. Python's
#: ``bytes.split()`` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column) -> Column:
    """CRC-32 of the key as text, modulo 5; fold 0 is held out. Null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % 5


def held_out(key: Column) -> Column:
    """True in fold 0; a null key is in no fold and so neither held out nor learnt from."""
    return F.coalesce(fold(key) == 0, F.lit(False))


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` different rows: those with the smallest seeded hash over all columns.

    Rows are counted, and a threshold that about 1.2 times as many pass is lowered or
    raised by what passed it; only those hashes are put in order, so that one task sees
    little more than the sample however many tasks there are. Wide columns are read
    again by the rows that pass and stay spread over tasks. Equal rows count once, so
    that a repeated key takes no more than its different rows. Rows with a null key take
    no part. The hash stays as column ``mark``.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != key]
    df = df.filter(F.col(key).isNotNull()).withColumn("mark", F.xxhash64(F.lit(seed), F.col(key), *others))
    n, wanted = df.count(), 1.2 * rows + 6 * rows**0.5 + 20
    share = min(1.0, wanted / n) if n else 1.0
    while True:
        below = int(share * 2**64) - 2**63 - 1
        few = df.filter(F.col("mark") <= F.lit(below).cast("bigint"))
        marks = few.select("mark").distinct()
        found = marks.count()
        if share == 1 or rows <= found <= 2 * wanted:
            break
        if found >= rows:  # more than expected
            share *= wanted / found
        else:  # copies weigh heavy: there are fewer different rows than rows
            share = min(1.0, share * max(2.0, wanted / max(1, found)))
    if found > rows:
        cut = marks.orderBy("mark").limit(rows).agg(F.max("mark")).head()[0]
        few = df.filter(F.col("mark") <= F.lit(cut).cast("bigint"))
    return few.dropDuplicates(["mark"])


def strings_of(batch: pa.RecordBatch, column: str) -> list[str | None]:
    """The texts of a batch; bytes that are no UTF-8 become U+FFFD."""
    return [None if t is None else t.decode("utf-8", "replace") for t in texts_of(batch, column)]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes | None]:
    """The texts of a batch as UTF-8 bytes, without decoding them; None for null."""
    values = batch.column(column)
    if pa.types.is_large_string(values.type):
        values = values.cast(pa.large_binary())
    else:
        values = values.cast(pa.binary())
    for value in values:
        yield value.as_py()
