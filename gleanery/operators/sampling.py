"""Bounded samples that do not depend on how rows are spread over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest_marks(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows: those with the smallest MD5 of the key, ties by all columns.

    Rows are counted, and a threshold that about 1.2 times as many rows pass is set
    before they are put in order, so that one task sees little more than the sample
    however many tasks there are. Only copies of one row can exceed that, so these are
    combined in each task first. Rows with a null key take no part.
    """
    df = df.filter(F.col(key).isNotNull())
    mark, digits = F.md5(F.col(key).cast("string").cast("binary")), 12
    n, wanted = df.count(), 1.2 * rows + 6 * rows**0.5 + 20
    few = df
    if n > 2 * wanted:
        few = df.filter(F.substring(mark, 1, digits) <= f"{int(wanted / n * 16**digits):0{digits}x}").distinct()
        if few.count() < rows:  # many rows share few keys
            few = df.distinct()
    return few.orderBy(mark, key, *[F.xxhash64(c) for c in df.columns if c != key]).limit(rows)
