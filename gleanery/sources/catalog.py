"""Tables by name: stated schemas that hold, overwriting, appending and growing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conforming(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types, others after them.

    A column that is missing or that is null in a row although the schema says NOT NULL
    fails the job and is named; a missing column that may be null is added as null.
    """
    have = {c.lower(): c for c in df.columns}
    absent = [f.name for f in schema if not f.nullable and f.name.lower() not in have]
    if absent:
        raise ValueError(f"columns {absent} must not be null, and are missing")
    columns = []
    for f in schema:
        value = F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)
        value = value.cast(f.dataType)
        if not f.nullable:
            value = F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"column {f.name} must not be null")).cast(f.dataType))
        columns.append(value.alias(f.name))
    stated = {f.name.lower() for f in schema}
    return df.select(*columns, *[F.col(f"`{c}`") for c in df.columns if c.lower() not in stated])


def _declared(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)


def create_table(df: DataFrame, name: str, schema: T.StructType, location: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Create table ``name`` with ``schema`` (columns beyond it may be null) and these rows.

    A table of that name gives way; its files stay if they lie at a location of their own.
    Nothing is created where the rows do not conform to the schema's names and types; a null in a row fails while
    writing and leaves the table empty.
    """
    spark, rows = df.sparkSession, conforming(df, schema)
    whole = T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType) for f in rows.schema.fields[len(schema.fields) :]]])
    where = f" LOCATION '{location}'" if location else ""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({_declared(whole)}) USING parquet{parts}{where}")
    _insert(rows, name, partition_by, True)


def append_table(df: DataFrame, name: str, schema: T.StructType) -> None:
    """Append rows by column name; a new column is added to the table first, null for older rows."""
    spark = df.sparkSession
    rows = conforming(df, schema)
    known = {c.lower() for c in spark.table(name).columns}
    new = [f for f in rows.schema if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    _insert(rows, name, parts, False)


def _insert(rows: DataFrame, name: str, partition_by: Sequence[str], overwrite: bool) -> None:
    have = {c.lower() for c in rows.columns}
    table = rows.sparkSession.table(name).schema
    ordered = rows.select(*[F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in table])
    dealt = ordered.hint("rebalance", *partition_by) if partition_by else ordered
    dealt.write.insertInto(name, overwrite=overwrite)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
