"""Keeping a keyed table in step with its source: diff and apply."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import written, written_counted

MOST_WORDS = 1 << 20  # of a filter, 64 bits each


def snapshot_diff(
    old: DataFrame, new: DataFrame, key: str = "chunk_id", content: Sequence[str] | None = None,
    keep_same: bool = False,
) -> DataFrame:
    """``key, change_type`` with insert, update and delete (and, on request, same).

    A row is changed if any column of ``content`` is, by default any column but
    the key that either snapshot has; nulls count as values of their own, and a column
    that a snapshot lacks is null there.

    Both snapshots are appended as key and content hash and meet in one
    aggregation: one shuffle of narrow rows, combined beforehand, and a key that
    occurs many times does not multiply.
    """
    if content is None:
        content = [*old.columns, *(c for c in new.columns if c not in old.columns)]
        content.remove(key)

    def digest(side: DataFrame):
        columns = [F.col(c) if c in side.columns else F.lit(None).cast("string").alias(c) for c in content]
        return F.unhex(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))

    sides = old.select(F.col(key), digest(old).alias("_old"), F.lit(None).cast("binary").alias("_new")).unionByName(
        new.select(F.col(key), F.lit(None).cast("binary").alias("_old"), digest(new).alias("_new"))
    )
    both = sides.groupBy(key).agg(
        F.max("_old").alias("_old"), F.max("_new").alias("_new"),
    )
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
        .otherwise("same")
    )
    out = both.select(key, change.alias("change_type"))
    return out if keep_same else out.where(F.col("change_type") != "same")


class KeyFilter:
    """Which rows may have one of many keys: a broadcast table of at most MOST_WORDS words of bits.

    Each key sets the bit that its hash names, so a row whose bit is not set has none of the
    keys. The more keys there are the more other rows pass; joins after it stay exact.
    ``n`` is the number of keys where it is known; else they are counted.
    """

    def __init__(self, keys: DataFrame, key: str, n: int | None = None):
        self.key, self.kind = key, keys.schema[key].dataType
        self.bits = 64 * min(MOST_WORDS, 1 << ((keys.count() if n is None else n) // 4).bit_length())
        bit = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
        words = keys.select(self._place().alias("_bit")).groupBy(F.expr("shiftright(_bit, 6)").alias("_word"))
        self.words = F.broadcast(words.agg(F.bit_or(bit).alias("_set")))

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast(self.kind)), F.lit(self.bits))

    def rows(self, df: DataFrame, inside: bool) -> DataFrame:
        """The rows that may have one of the keys, or those that have none."""
        marked = df.withColumn("_bit", self._place()).withColumn("_word", F.expr("shiftright(_bit, 6)")).join(self.words, "_word", "left")
        passed = F.expr("coalesce(shiftright(_set, cast(_bit & 63 as int)) & 1L, 0L) = 1L")
        return marked.where(passed if inside else ~passed).select(*df.columns)


def without_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among many ``keys``; only rows that may have one of them are shuffled."""
    given = KeyFilter(keys, key)
    left = given.rows(df, True).join(keys.select(key), key, "left_anti").select(*df.columns)
    return given.rows(df, False).unionByName(left)


def change_rows(changes: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The changes with the new row; deletes carry nulls."""
    upserts = new.join(changes.where(F.col("change_type") != "delete"), key)
    deletes = changes.where(F.col("change_type") == "delete")
    return upserts.unionByName(deletes, allowMissingColumns=True)


def apply_changes(base: DataFrame, changes: DataFrame, key: str = "chunk_id") -> DataFrame:
    """``base`` after the changes: upserts replaced by key, deletes left out."""
    kept = base.join(changes.select(key), key, "left_anti").select(*base.columns)
    upserts = changes.where(F.col("change_type") != "delete").select(*base.columns)
    return kept.unionByName(upserts)


def refresh(
    base: DataFrame, new: DataFrame, key: str = "chunk_id", content: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(changes, table)``: what a new snapshot changes, and the table after it.

    Keys of changes are written first and the changed rows after them. A filter over
    these keys picks, where the rows lie, those that may have changed; no other row of a
    snapshot is shuffled with its texts.
    """
    keys, n = written_counted(snapshot_diff(base, new, key, content), "diff")
    changed = KeyFilter(keys, key, n)
    changes = written(change_rows(keys, changed.rows(new, True), key), "changes", "zstd")
    table = changed.rows(base, False).unionByName(apply_changes(changed.rows(base, True), changes, key))
    return changes, table


def reconcile(source: DataFrame, index: DataFrame, source_key: str, index_key: str) -> DataFrame:
    """One row: rows on both sides, and keys that only one side holds."""
    flags = source.select(F.col(source_key).alias("k"), F.lit(1).alias("s"), F.lit(0).alias("i")).union(
        index.select(F.col(index_key).alias("k"), F.lit(0).alias("s"), F.lit(1).alias("i"))
    )
    per_key = flags.groupBy("k").agg(F.sum("s").alias("s"), F.sum("i").alias("i"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_key.agg(
        total("s").alias("source_rows"),
        total("i").alias("index_rows"),
        (total("s") - total("i")).alias("row_gap"),
        total(F.when(F.col("i") == 0, 1)).alias("missing_in_index"),
        total(F.when(F.col("s") == 0, 1)).alias("orphans_in_index"),
    )
