"""Assessment events arriving as a stream.

Micro-batches go through the same cleaning and the same rules as the batch table. A
batch becomes visible with one version of the sink, and a batch that a version has is not
stored again, so rows are exactly-once although the callback may run twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.operators.dedup import deduplicate, raw_keys
from gaugeworks.operators.quality import quality_suite
from gaugeworks.operators.standardise import rejected_rows, standardise_entity
from gaugeworks.plans.concurrent import concurrently
from gaugeworks.sources.shared import materialise_by_key, staged
from gaugeworks.spec import EntitySpec
from gaugeworks.streaming.tables import ORIGIN, StreamSink, newest_rows

CORRUPT = "_corrupt_record"
DEFAULT_TRIGGER = "60 seconds"


def read_events(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Streaming source of any format; file formats need a schema and a directory."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def decode_events(
    raw: DataFrame, schema: T.StructType, payload: str = "data", corrupt: str | None = None
) -> DataFrame:
    """JSON payloads as columns; a malformed payload or field is null.

    ``corrupt`` names an extra column with the text of every payload that could
    not be decoded, or only in part. The generator keeps later filters above the
    parser; pushed below it, each of them would parse the text once more.
    """
    options = {}
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    event = F.from_json(F.col(payload).cast("string"), schema, options)
    return raw.select(F.inline(F.array(event)))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Persistent id of a query, which its checkpoint holds from the first start on."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def store_micro_batch(
    raw: DataFrame,
    batch_id: int,
    sink: StreamSink,
    stream: str,
    spec: EntitySpec,
    schema: T.StructType,
    payload: str = "data",
) -> None:
    """Decode, clean, store and check one micro-batch.

    The decoded events feed several tables, so they are stored in the shared folder for
    the time of the batch, by key, which spares the shuffle that drops duplicates. Rules are measured on the stored rows, and on the decoded
    events where cleaning drops rows. No foreign keys are checked here. All tables of
    the batch change in one version, which the merged table and the merged report follow.
    """
    spark = raw.sparkSession
    batch = sink.batch(spark, stream, batch_id)
    if batch is None:
        return
    keys = raw_keys(schema.names, spec)
    with staged(decode_events(raw, schema, payload, corrupt=CORRUPT), "events", keys) as decoded:
        events = decoded.drop(CORRUPT).where(F.col(CORRUPT).isNull() | _has_values(schema))
        rejected = decoded.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("payload"))
        clean = standardise_entity(events, spec, rebalance=True)
        concurrently(
            spark,
            {
                "rows": lambda: batch.write("rows", clean, spec.partition_by, rebalance=False),
                "rejected": lambda: batch.write("rejected", rejected),
                "rejected_rows": lambda: batch.write("rejected_rows", rejected_rows(events, spec)),
            },
        )
        stored = spark.read.schema(clean.schema).parquet(batch.folder("rows"))
        batch.write("quality", quality_suite(stored, spec, source=events))
        batch.commit(spec, stored.drop(spec.audit_column))
    sink.compact(spark, {"rows": spec.partition_by})


def _has_values(schema: T.StructType) -> Column:
    """Whether an event that was decoded in part has any value."""
    return reduce(lambda a, b: a | b, [F.col(f.name).isNotNull() for f in schema.fields])


def start_stream(
    events: DataFrame,
    sink: StreamSink,
    spec: EntitySpec,
    schema: T.StructType,
    checkpoint: str,
    trigger: str = DEFAULT_TRIGGER,
    available_now: bool = False,
    payload: str = "data",
) -> StreamingQuery:
    """Run micro-batches on an interval, or over all that is available.

    The size of a batch is the source's to limit, by ``maxFilesPerTrigger`` for files.
    """

    def store(raw: DataFrame, batch_id: int) -> None:
        stream = query_id(raw.sparkSession, checkpoint)
        store_micro_batch(raw, batch_id, sink, stream, spec, schema, payload)

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_stream_table(
    spark: SparkSession, sink: StreamSink, kind: str, schema: T.StructType
) -> DataFrame:
    """All stored micro-batches at the last version, with the stream and batch they came from.

    ``_order`` tells the order of batches over all streams: streams in the order of their
    first start, then batches by number.
    """
    return sink.read(spark, kind, schema)


def merge_batches(
    streamed: DataFrame,
    spec: EntitySpec,
    batch: DataFrame | None = None,
    newest_first: bool = True,
    stored: bool = False,
) -> DataFrame:
    """One row per key over all micro-batches, and over the batch table when given.

    Micro-batches only lose their own duplicates; a student in two of them, or in the
    stream and in the batch table, is stored twice. Here the newest batch wins, the batch
    table comes before all of them, and ties go to the smallest row. Batches follow by
    ``_order``, or by number if there is no such column. Without ``newest_first`` the choice is
    the batch path's, so the result equals that of one batch over all events. With
    ``stored`` the rows are stored by key first, and merged without a shuffle.
    """
    columns = [c for c in streamed.columns if c not in (*ORIGIN, spec.audit_column)]
    order = "_order" if "_order" in streamed.columns else "_batch_id"
    rows = streamed.select(*columns, F.col(order).alias("_newest"))
    if batch is not None:
        rows = rows.unionByName(batch.select(*columns, F.lit(-1).cast("long").alias("_newest")))
    if not newest_first:
        rows = rows.drop("_newest")
    if stored:
        rows = materialise_by_key(rows, "merged", spec.dedup_keys)
    if not newest_first:
        return deduplicate(rows, spec)
    return newest_rows(rows, spec.dedup_keys, spec.mandatory).drop("_newest")
