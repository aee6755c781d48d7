"""Storing and reading quality reports as JSON documents."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.quality import report_documents
from gaugeworks.sources.shared import hadoop_path

# State of a document without one, and the time in its file name.
UNKNOWN_STATUS = "DESCONHECIDO"
FILE_TIME = r"_(\d{4})(\d\d)(\d\d)T(\d\d)(\d\d)(\d\d)\.json$"

# Written with microseconds; the JSON default would cut them to milliseconds.
_TIME_FORMAT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

_CHECKS = "array<struct<regra: string, coluna: string, status: string>>"
_DOCUMENT_SCHEMA = (
    f"entidade string, status_geral string, reported_at timestamp_ntz, checks {_CHECKS}"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def write_documents(documents: DataFrame, path: str) -> None:
    """Store report documents; a path is written once, so a retry replaces it."""
    documents.write.mode("overwrite").options(**_TIME_FORMAT).json(path)


def save_report(report: DataFrame, reports_dir: str, run_id: str, at: datetime) -> None:
    """Add a run's report to the report table.

    Each run and entity has a folder of its own: runs never overwrite each other
    and repeating a run changes nothing.
    """
    documents = report_documents(report).withColumn(
        "reported_at", F.lit(at.isoformat()).cast("timestamp_ntz")
    )
    write_documents(documents, f"{reports_dir.rstrip('/')}/run_id={run_id}")


def read_reports(spark: SparkSession, path: str, pretty_printed: bool = False) -> DataFrame:
    """Report documents with defaults for missing fields.

    A document without an entity takes its file name, one without a time takes the UTC
    time in its file name, or else the time the file was written, so that every report
    has a time and none is left out of the alarms. ``pretty_printed`` reads files that hold one
    document over many lines.
    """
    reader = spark.read.schema(_DOCUMENT_SCHEMA).options(**_report_options(pretty_printed))
    return _with_defaults(reader.json(path))


def report_stream(spark: SparkSession, path: str, pretty_printed: bool = False) -> DataFrame:
    """The same documents as a stream of report files; the folder may not exist yet."""
    place, files = hadoop_path(spark, path)
    files.mkdirs(place)
    reader = spark.readStream.schema(_DOCUMENT_SCHEMA).options(**_report_options(pretty_printed))
    return _with_defaults(reader.json(path))


def _report_options(pretty_printed: bool) -> dict:
    fixed = {"recursiveFileLookup": True, "pathGlobFilter": "*.json", **_TIME_FORMAT}
    return {"multiLine": pretty_printed, **fixed}


def _with_defaults(documents: DataFrame) -> DataFrame:
    file_name = F.col("_metadata.file_name")
    file_time = F.regexp_replace(
        F.regexp_extract(file_name, FILE_TIME, 0), FILE_TIME, "$1-$2-$3 $4:$5:$6"
    ).try_cast("timestamp_ntz")
    written = F.expr(
        "timestamp_ntz'1970-01-01 00:00:00'"
        " + make_dt_interval(0, 0, 0, unix_micros(_metadata.file_modification_time) / 1e6)"
    )
    return documents.select(
        F.coalesce("entidade", file_name).alias("entidade"),
        F.coalesce("status_geral", F.lit(UNKNOWN_STATUS)).alias("status_geral"),
        F.coalesce("reported_at", file_time, written).alias("reported_at"),
        F.coalesce("checks", F.array().cast(_CHECKS)).alias("checks"),
    )
