"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.sources.shared import materialise

# The white space that separates words, as a regular expression and as characters.
WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARACTERS = " \t\n\x0b\x0c\r"
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; ``bytes.split`` cuts at exactly ``WHITE``."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches end at ``BATCH_BYTES`` in jobs that the block runs; one row may be larger.

    A batch exists several times at once, in buffers outside the heap and in the Python
    worker, so with Spark's own limit of 64 MB texts take much more than they need. Results
    must not depend on where batches end. The setting is the session's: jobs of other threads
    get smaller batches too.
    """
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def map_batches(
    df: DataFrame, function: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str | StructType
) -> DataFrame:
    """Apply a function to Arrow batches; ``function()`` makes it once per task.

    It returns the columns of its output, in the order of ``schema``.
    """
    kinds = df.sparkSession.createDataFrame([], schema).schema
    arrow = arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = function()
        for batch in batches:
            if batch.num_rows:
                columns = convert(batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        c if isinstance(c, pa.Array) else pa.array(c, kind)
                        for c, kind in zip(columns.values(), arrow.types, strict=True)
                    ],
                    schema=arrow,
                )

    return df.mapInArrow(run, kinds)


def arrow_rows(columns: dict, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Columns of equal length as Arrow batches of limited length."""
    arrays = [pa.array(c) for c in columns.values()]
    for at in range(0, len(arrays[0]), rows):
        yield pa.RecordBatch.from_arrays([a.slice(at, rows) for a in arrays], list(columns))


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component) of every endpoint of ``edges`` (a, b); component is the smallest id reached.

    Every round maps a node to the neighbour (or itself) whose hash of that round is
    smallest and contracts the graph. A random order shrinks any graph by a constant
    factor, so rounds grow with the logarithm of the longest path. Each step is a
    partial aggregation or an equi-join on stored tables; nothing reaches the driver.
    """
    edges = edges.where("a <> b").select("a", "b")
    edges = materialise(edges.union(edges.select("b", "a")).distinct(), f"{name}-edges")
    ids = materialise(edges.select(F.col("a").alias("id")).distinct(), f"{name}-ids")
    current = ids.withColumn("root", F.col("id"))
    step = 0
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(step)).alias("h"), F.col(c).alias("p"))  # noqa: E731, B023
        parents = materialise(
            edges.groupBy("a").agg(F.min(order("b")).alias("m")).select("a", F.least(order("a"), F.col("m")).getField("p").alias("p")),
            f"{name}-parents",
        )
        current = materialise(
            current.join(parents.withColumnRenamed("a", "root"), "root", "left").select("id", F.coalesce("p", "root").alias("root")),
            f"{name}-current",
        )
        edges = (
            edges.join(parents.withColumnRenamed("p", "pa"), "a")
            .join(parents.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b"))
            .distinct()
        )
        edges = materialise(edges, f"{name}-edges")
        step += 1
    smallest = current.groupBy("root").agg(F.min("id").alias("component"))
    return current.join(smallest, "root").select("id", "component")
