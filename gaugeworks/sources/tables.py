"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table at ``path`` in any format the session knows.

    CSV has a header row and is read as text unless a schema is given: cleaning
    parses the text anyway, and inference would cost a second pass. A schema also
    fixes the types of partition columns instead of leaving them to discovery.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is not None:
            # The file's own column order decides, so match the names strictly.
            reader = reader.option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {})).load(path)


def rebalanced(df: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Rows dealt for a write that is partitioned by the columns they have among these."""
    present = [c for c in partition_by if c in df.columns]
    return df.hint("rebalance", *present) if present else df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
    rebalance: bool = True,
) -> None:
    """Write a table, partitioned by the columns it has among ``partition_by``.

    Rows are rebalanced on the partition columns first. Otherwise every task
    would write a small file into every partition; a plain repartition would send
    a hot partition to one task, whereas rebalancing splits it by size. Without
    ``rebalance`` it is left out, for rows that come from files of the same partitions or
    were rebalanced before.
    """
    present = [c for c in partition_by if c in df.columns]
    writer = (rebalanced(df, present) if rebalance else df).write
    if present:
        writer = writer.partitionBy(*present)
    writer.mode(mode).format(fmt).save(path)


def publish_table(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] = (),
    fmt: str = "parquet",
    rebalance: bool = True,
) -> DataFrame:
    """Write a table and return it as stored, with the types it was written with."""
    write_table(df, path, partition_by, fmt, rebalance=rebalance)
    return read_table(df.sparkSession, path, fmt, df.schema).select(*df.columns)


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
