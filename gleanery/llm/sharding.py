"""Sharding with a permutation-filled lookup table.

Shards take turns; each claims the next free slot of a table of prime size in its own
order of preference, a permutation given by an offset and a skip. Every shard gets the
same number of slots, one more or less, and when a shard goes, few other slots move. A
key's place is the slot at its hash modulo the table's size: one look-up in a broadcast
table whose size is a parameter, whatever the number of keys.
"""

from __future__ import annotations

from collections.abc import Sequence
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime. A hundred times the number of shards keeps their slots within 1 %.
SLOTS = 4099
MOST_SLOTS = 1_000_003


def number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def filled(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard of each slot, as an index into ``shards``.

    ``slots`` must be a prime above the number of shards and at most MOST_SLOTS, which
    bounds the broadcast. Names must differ.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must have different names, at least one")
    if not len(shards) < slots <= MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime above {len(shards)} and at most {MOST_SLOTS}")
    offset = [number(f"offset:{s}") % slots for s in shards]
    skip = [number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    tried, owner, left = [0] * len(shards), [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while True:
                slot = (offset[i] + tried[i] * skip[i]) % slots
                tried[i] += 1
                if owner[slot] < 0:
                    break
            owner[slot] = i
            left -= 1
            if not left:
                return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``slot`` and ``shard``, one row for each slot."""
    names = F.array(*[F.lit(s) for s in shards])
    owners = F.split(F.lit(",".join(map(str, filled(shards, slots)))), ",")
    rows = spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
    return rows.select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The first 60 bits of the key's MD5 modulo the table's size. A null key counts as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots).cast("bigint")).cast("int")


def placed(df: DataFrame, key_col: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The key column with its ``slot`` and ``shard``, one row for each input row.

    Equal keys share a shard; null keys go where the empty text goes. Other columns are
    not looked at. One narrow pass with a broadcast of ``slots`` rows.
    """
    keyed = df.select(F.col(key_col), slot_of(F.col(key_col), slots).alias("slot"))
    return keyed.join(F.broadcast(lookup_table(df.sparkSession, shards, slots)), "slot").select(key_col, "slot", "shard")


def write_shards(df: DataFrame, key_col: str, shards: Sequence[str], path: str, slots: int = SLOTS) -> None:
    """Write all columns of ``df`` as Parquet, one folder for each shard.

    Rows are dealt out by slot, so that a shard is written by many tasks and a hot shard
    by no single one; Spark splits what is too large.
    """
    inner = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), slot_of(F.col(key_col), slots).alias("slot"))
    dealt = inner.join(F.broadcast(lookup_table(df.sparkSession, shards, slots)), "slot").hint("rebalance", "slot")
    name = "shard" if "shard" not in {c.lower() for c in df.columns} else "shard_name"
    out = dealt.select("row.*", F.col("shard").alias(name))
    out.write.partitionBy(name).parquet(path)
