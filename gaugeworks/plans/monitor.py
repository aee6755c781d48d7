"""Metrics and alarms from quality reports."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.quality import ALERT, OK

# Metric names.
CHECK_ALERTS = "QualityCheckAlerts"
RUN_STATUS = "PipelineRunStatus"


@dataclass(frozen=True)
class AlarmRule:
    """Breaches when the statistic of a metric over a period exceeds a threshold."""

    name: str
    metric: str
    statistic: Literal["max", "sum"]
    threshold: float
    period: str = "1 hour"


# Alarm names, statistics and thresholds.
ALARMS = (
    AlarmRule("Qualidade-Com-Alerta", RUN_STATUS, "max", 0),
    AlarmRule("Muitos-Alertas-Qualidade", CHECK_ALERTS, "sum", 3),
)


def report_metrics(reports: DataFrame) -> DataFrame:
    """Two metrics per report: its alerting checks, and 0 or 1 for its state."""
    alerts = F.size(F.filter("checks", lambda check: check["status"] == ALERT))
    failed = F.when(F.col("status_geral") == OK, 0).otherwise(1)
    return reports.select(
        "entidade", "reported_at", alerts.alias(CHECK_ALERTS), failed.alias(RUN_STATUS)
    ).unpivot(["entidade", "reported_at"], [CHECK_ALERTS, RUN_STATUS], "metrica", "valor")


def evaluate_alarms(metrics: DataFrame, rules: tuple[AlarmRule, ...] = ALARMS) -> DataFrame:
    """State of every alarm per entity and period that has data.

    A period without data has no row, which is not a breach. All rules share one
    aggregation; the partial step folds a hot entity before the shuffle.
    """
    by_period: dict[str, list[AlarmRule]] = {}
    for rule in rules:
        by_period.setdefault(rule.period, []).append(rule)
    result = None
    for period, group in by_period.items():
        states = _evaluate(metrics, period, group)
        result = states if result is None else result.unionByName(states)
    return result


def _evaluate(metrics: DataFrame, period: str, rules: list[AlarmRule]) -> DataFrame:
    wanted = metrics.filter(F.col("metrica").isin(*{r.metric for r in rules}))
    statistics = []
    for i, rule in enumerate(rules):
        value = F.when(F.col("metrica") == rule.metric, F.col("valor"))
        aggregate = F.max(value) if rule.statistic == "max" else F.sum(value)
        statistics.append(aggregate.cast("double").alias(f"s{i}"))
    return (
        wanted.groupBy("entidade", F.window("reported_at", period).alias("w"))
        .agg(*statistics)
        .select("entidade", F.col("w.start").alias("inicio"), F.inline(alarm_states(rules)))
        .filter(F.col("estatistica").isNotNull())
    )


def alarm_states(rules: Iterable[AlarmRule]) -> Column:
    """Array with the state of every rule, from the statistics s0, s1 and so on."""
    states = [
        F.struct(
            F.lit(rule.name).alias("alarme"),
            F.col(f"s{i}").alias("estatistica"),
            F.lit(float(rule.threshold)).alias("limite"),
            F.coalesce(F.col(f"s{i}") > rule.threshold, F.lit(False)).alias("em_alarme"),
        )
        for i, rule in enumerate(rules)
    ]
    return F.array(*states)
