"""Quality reports as a stream: every report becomes metrics once, and alarms follow.

Spark's file source keeps the list of report files that were read in the checkpoint, so
a run takes only what is new. Metrics of a run belong to its micro-batch, which a
replay does not store again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.quality import OK
from gaugeworks.plans.monitor import ALARMS, CHECK_ALERTS, RUN_STATUS, AlarmRule, alarm_states, report_metrics
from gaugeworks.sources.reports import report_stream
from gaugeworks.streaming.students import query_id
from gaugeworks.streaming.tables import StreamSink

METRICS = "metrics"
_METRIC_SCHEMA = "entidade string, reported_at timestamp_ntz, metrica string, valor int"


def publish_new_reports(spark: SparkSession, reports_dir: str, sink: StreamSink, checkpoint: str) -> DataFrame:
    """Store the metrics of all reports that are new since the last run; returns the new ones.

    The checkpoint is the cursor. A report file is read once, whenever it arrives and however
    late its own time is.
    """
    before = [r[0] for r in read_metrics(spark, sink).select("_order").distinct().collect()]  # one per run

    def store(reports: DataFrame, batch_id: int) -> None:
        session = reports.sparkSession
        batch = sink.batch(session, query_id(session, checkpoint), batch_id)
        if batch is not None:
            batch.write(METRICS, report_metrics(reports))
            batch.commit_parts()
        sink.compact(session)

    writer = report_stream(spark, reports_dir).writeStream.foreachBatch(store)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return read_metrics(spark, sink).where(~F.col("_order").isin(before)).drop("_stream", "_batch_id", "_order")


def read_metrics(spark: SparkSession, sink: StreamSink) -> DataFrame:
    """All metrics published so far, with the run they came from."""
    return sink.read(spark, METRICS, spark.createDataFrame([], _METRIC_SCHEMA).schema)


def alarm_stream(
    reports: DataFrame, late: str, rules: tuple[AlarmRule, ...] = ALARMS
) -> DataFrame:
    """States of all alarms per entity and period, as a stream in update mode.

    A period is kept in state until reports ``late`` newer than its end have been seen; until
    then a report of any time changes its period, whatever the order of arrival. Each
    output row replaces earlier ones of its entity, period and alarm. All rules have one
    period here, and their two metrics are made without unpivoting, so one aggregation does.
    """
    periods = {rule.period for rule in rules}
    if len(periods) != 1:
        raise ValueError("alarms of a stream share one period")
    timed = reports.withColumn("reported_at", F.col("reported_at").cast("timestamp")).withWatermark("reported_at", late)
    alerts = F.size(F.filter("checks", lambda check: check["status"] == "ALERTA"))
    values = {CHECK_ALERTS: alerts, RUN_STATUS: F.when(F.col("status_geral") == OK, 0).otherwise(1)}
    statistics = [
        (F.max if rule.statistic == "max" else F.sum)(values[rule.metric]).cast("double").alias(f"s{i}")
        for i, rule in enumerate(rules)
    ]
    window = F.window("reported_at", periods.pop()).alias("w")
    grouped = timed.groupBy("entidade", window).agg(*statistics)
    return grouped.select(
        "entidade", F.col("w.start").cast("timestamp_ntz").alias("inicio"), F.inline(alarm_states(rules))
    )


_ALARM_KEYS = ("entidade", "inicio", "alarme")
_ALARM_SCHEMA = (
    "entidade string, inicio timestamp_ntz, alarme string, estatistica double, limite double, em_alarme boolean"
)


def run_alarm_stream(
    spark: SparkSession, reports_dir: str, sink: StreamSink, checkpoint: str, late: str
) -> DataFrame:
    """Bring the stored alarms up to date with all new reports; returns the alarms in force."""

    def store(states: DataFrame, batch_id: int) -> None:
        session = states.sparkSession
        batch = sink.batch(session, query_id(session, checkpoint), batch_id)
        if batch is not None:
            batch.write("alarms", states)
            batch.commit_parts()
        sink.compact(session)

    stream = alarm_stream(report_stream(spark, reports_dir), late)
    writer = stream.writeStream.outputMode("update").foreachBatch(store)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return read_alarms(spark, sink)


def read_alarms(spark: SparkSession, sink: StreamSink) -> DataFrame:
    """The last state of every alarm per entity and period."""
    stored = sink.read(spark, "alarms", spark.createDataFrame([], _ALARM_SCHEMA).schema)
    values = [c for c in stored.columns if c not in (*_ALARM_KEYS, "_stream", "_batch_id", "_order")]
    last = F.max_by(F.struct(*values), "_order").alias("last")
    return stored.groupBy(*_ALARM_KEYS).agg(last).select(*_ALARM_KEYS, "last.*")
