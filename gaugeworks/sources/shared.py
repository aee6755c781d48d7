"""Intermediate tables in the folder shared by the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
# Tables stored by key and payloads are read by this library only; zstd halves them against snappy.
CODEC = "zstd"
_MOST_BUCKETS = 128
# A bucket may have so many times the mean, and so many rows at least, before keys count as uneven.
_UNEVEN, _FEW_ROWS = 4, 100_000


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="gaugeworks-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared folder.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session
    may lack the setting; it then gets a temporary folder, as in tests.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/gaugeworks/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """Path and file system, whatever the file system is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own."""
    place, files = hadoop_path(spark, path)
    files.delete(place, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``, on one file system."""
    source, files = hadoop_path(spark, new)
    target, _ = hadoop_path(spark, path)
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{new} could not be renamed to {path}")


_RECORDS: list[list[str]] = []


def _recorded(path: str) -> None:
    for record in _RECORDS:
        record.append(path)


@contextmanager
def recorded_intermediates() -> Iterator[list[str]]:
    """The folders of all tables that are materialised while the block runs.

    Whoever stores the result of the block can remove them afterwards: nothing else reads them.
    """
    record: list[str] = []
    _RECORDS.append(record)
    try:
        yield record
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not record]


def stored_alone(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The result of ``build``, stored, after the tables that it made on its way are removed."""
    with recorded_intermediates() as record:
        result = build()
        path = shared_folder(spark, name)
        result.write.parquet(path)
    for folder in record:
        remove_folder(spark, folder)
    _recorded(path)
    return spark.read.schema(result.schema).parquet(path).select(*result.columns)


@contextmanager
def staged(df: DataFrame, name: str, keys: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``df`` stored in the shared folder while the block runs, and removed afterwards.

    With ``keys`` it is stored as by ``materialise_by_key``.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    try:
        yield _stored_by_key(df, path, keys)
    finally:
        remove_folder(spark, path)


def materialise(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    This cuts the lineage in storage that outlives any executor, lets several
    consumers share the work, and gives the planner a true size, so a small
    table is broadcast only because it is known to be small.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    _recorded(path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialise_by_key(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """As ``materialise``, dealt by hash of ``keys``: a window, join or grouping by these
    columns, or by more, needs no shuffle.

    Rows then travel as compressed columns, a fraction of the bytes that a shuffle of whole rows
    writes. If a few buckets have most rows, as with a key that many rows share, the files are
    read as any others, and Spark folds and shuffles the rows.
    """
    path = shared_folder(df.sparkSession, name)
    _recorded(path)
    return _stored_by_key(df, path, keys)


def _stored_by_key(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    spark, schema = df.sparkSession, df.schema
    if not keys or any(k not in df.columns for k in keys):
        df.write.parquet(path, compression=CODEC)
        return spark.read.schema(schema).parquet(path).select(*df.columns)
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), _MOST_BUCKETS)
    table = f"gaugeworks_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", CODEC).option("path", path)
    writer.bucketBy(buckets, *keys).saveAsTable(table)
    try:
        dealt = spark.table(table).select(*df.columns)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # of the session's catalog; the files stay
    plain = spark.read.schema(schema).parquet(path).select(*df.columns)
    rows = plain.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")).count()
    total, most = rows.agg(F.sum("count"), F.max("count")).first()
    even = total is None or most <= max(_FEW_ROWS, _UNEVEN * total / buckets)
    return dealt if even else plain
