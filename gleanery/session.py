"""Session helpers: where durable scratch data goes, and how scans are spread."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names a store that every executor reaches. Only
    where it is unset on a single machine (tests) is a temporary folder made, and
    then it is set on the session so that later calls agree on it. A cluster
    without the setting is an error: its machines share no temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} reach")
        root = tempfile.mkdtemp(prefix="gleanery-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Repartition a scan that has fewer splits than the cluster has slots.

    Meant for a plain scan in front of CPU-heavy per-row work. A scan that
    already fills the cluster passes through without a shuffle.
    """
    slots = partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots)


def written(df: DataFrame, purpose: str, compression: str | None = None, **options) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Later uses read the table instead of repeating the work, also after an
    executor was lost. Spark then knows the table's size, so that its own
    threshold decides whether a join broadcasts it. ``compression`` is for tables of
    texts, which zstd makes smaller than the session's codec; ``options`` are the writer's.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def written_counted(df: DataFrame, purpose: str, **options) -> tuple[DataFrame, int]:
    """As :func:`written`, with the number of rows, counted while they are written."""
    seen = Observation()
    table = written(df.observe(seen, F.count(F.lit(1)).alias("rows")), purpose, **options)
    return table, seen.get["rows"]
