"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_id(url: Column | str, index: Column | str) -> Column:
    """First 16 hex digits of SHA-256 over ``url::index``."""
    url = F.col(url) if isinstance(url, str) else url
    index = F.col(index) if isinstance(index, str) else index
    joined = F.concat(url, F.lit("::"), index.cast("string"))
    return F.substring(F.sha2(joined, 256), 1, 16)


def in_sample(key: Column | str, share: float) -> Column:
    """A repeatable sample: the key's SHA-256 prefix lies below ``share``."""
    key = F.col(key) if isinstance(key, str) else key
    prefix = F.substring(F.sha2(key.cast("string"), 256), 1, 8)
    return F.conv(prefix, 16, 10).cast("bigint") < F.lit(int(share * 2**32))
