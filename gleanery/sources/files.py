"""Page files in a folder, read by the executors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions import text as X


def _drop_bad_bytes(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def decode_utf8(content: Column | str) -> Column:
    """Bytes to text; bytes that are no valid UTF-8 are dropped.

    Only rows that hold such bytes travel to Python; the rest is a cast.
    """
    raw = F.col(content) if isinstance(content, str) else content
    plain = raw.cast("string")
    bad = F.when(~F.is_valid_utf8(plain), raw)
    repaired = F.pandas_udf(_drop_bad_bytes, T.StringType())(bad)
    return F.coalesce(repaired, plain)


def read_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file_name, is_html, raw`` for every page file below ``folder``.

    The listing is filtered by extension before any byte is read, and each
    executor reads its own share of the files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{html,htm,md}")
        .load(folder)
    )
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    return files.select(
        name.alias("file_name"),
        name.rlike(r"\.(html|htm)\z").alias("is_html"),
        decode_utf8("content").alias("raw"),
    ).where(X.has_page_extension("file_name"))
