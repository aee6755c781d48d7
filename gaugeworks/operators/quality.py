"""Quality rules.

All counting rules of a table share one aggregation over one scan; every foreign
key adds one anti-join. The report is a DataFrame with one row per rule and
column, whose size depends on the spec only, never on the data. Offending values
are unbounded and therefore live in a frame of their own (``domain_offenders``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import absent_key, unfit_key
from gaugeworks.operators.standardise import ABSENT_KEY, UNFIT_KEY, named_columns
from gaugeworks.spec import DomainRule, EntitySpec, ForeignKey, RangeRule

# Rule names, states and the alert level of a report.
DUPLICATES = "duplicidade"
INCOMPLETE = "chave_incompleta"
MISSING = "valores_ausentes"
FOREIGN_KEY = "chave_relacionamento"
OK = "OK"
ALERT = "ALERTA"
NOT_APPLICABLE = "N/A"
MISSING_ALERT_PERCENT = 5.0

REPORT_SCHEMA = (
    "entidade string, regra string, coluna string, total_registros bigint, "
    "violacoes bigint, percentual double, status string"
)


class QualityAlert(ValueError):
    """A report with alerts reached a gate that must not let it pass."""


@dataclass(frozen=True)
class Check:
    """One counting rule: an aggregate that counts violations, None if not applicable."""

    rule: str
    label: str
    violations: Column | None
    alert_percent: float | None = None


def duplicate_check(df: DataFrame, keys: Iterable[str]) -> Check:
    """Rows beyond the first of each complete key.

    A row with an incomplete key identifies nothing, so cleaning keeps it and it is no
    duplicate; ``incomplete_check`` counts such rows.
    """
    keys = list(keys)
    label = ",".join(keys)
    if any(k not in df.columns for k in keys):
        return Check(DUPLICATES, label, None)
    if not keys:
        return Check(DUPLICATES, label, F.lit(0))
    # count_distinct of several columns skips rows with a null among them
    distinct = F.count_distinct(*keys)
    return Check(DUPLICATES, label, F.count_if(~_any_null(keys)) - distinct)


def incomplete_check(df: DataFrame, keys: Iterable[str]) -> Check:
    """Rows with a null in their key; alerts like missing values."""
    keys = list(keys)
    label = ",".join(keys)
    if any(k not in df.columns for k in keys):
        return Check(INCOMPLETE, label, None)
    violations = F.count_if(_any_null(keys)) if keys else F.lit(0)
    return Check(INCOMPLETE, label, violations, MISSING_ALERT_PERCENT)


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def key_checks(source: DataFrame, spec: EntitySpec) -> list[Check]:
    """Mandatory columns of the source as it came: values that are missing or do not fit.

    Cleaning drops rows without a mandatory value, so the stored table cannot tell.
    """
    named = named_columns(source, spec)
    widths = dict(spec.padded_keys)
    checks = []
    for c in spec.mandatory:
        if c not in named.columns:
            continue
        absent = F.count_if(absent_key(F.col(c)))
        checks.append(Check(ABSENT_KEY, c, absent, MISSING_ALERT_PERCENT))
        if c in widths:
            unfit = unfit_key(F.col(c), named.schema[c].dataType, widths[c])
            checks.append(Check(UNFIT_KEY, c, F.count_if(unfit)))
    return checks


def source_report(source: DataFrame, spec: EntitySpec) -> DataFrame:
    """Report rows on the mandatory columns of a source, from one scan of them."""
    return measure(named_columns(source, spec), spec.name, key_checks(source, spec))


def missing_checks(df: DataFrame, columns: Iterable[str]) -> list[Check]:
    """Null counts; a column alerts when its null share reaches the alert level."""
    return [
        Check(MISSING, c, F.count_if(F.col(c).isNull()), MISSING_ALERT_PERCENT)
        for c in dict.fromkeys(columns)
        if c in df.columns
    ]


def range_check(df: DataFrame, rule: RangeRule) -> Check:
    if rule.column not in df.columns:
        return Check(rule.rule, rule.column, None)
    outside = ~F.col(rule.column).try_cast("double").between(rule.low, rule.high)
    return Check(rule.rule, rule.column, F.count_if(outside))


def outside_domain(rule: DomainRule) -> Column:
    return F.col(rule.column).isNull() | ~F.col(rule.column).isin(*rule.allowed)


def domain_check(df: DataFrame, rule: DomainRule) -> Check:
    if rule.column not in df.columns:
        return Check(rule.rule, rule.column, None)
    return Check(rule.rule, rule.column, F.count_if(outside_domain(rule)))


def domain_offenders(df: DataFrame, entity: str, rule: DomainRule) -> DataFrame:
    """Every distinct offending value, null included, with its number of rows."""
    return (
        df.filter(outside_domain(rule))
        .groupBy(F.col(rule.column).alias("valor"))
        .agg(F.count(F.lit(1)).alias("registros"))
        .select(
            F.lit(entity).alias("entidade"),
            F.lit(rule.rule).alias("regra"),
            F.lit(rule.column).alias("coluna"),
            "valor",
            "registros",
        )
    )


def spec_checks(df: DataFrame, spec: EntitySpec) -> list[Check]:
    """All counting rules a spec asks for."""
    return [
        duplicate_check(df, spec.dedup_keys),
        incomplete_check(df, spec.dedup_keys),
        *missing_checks(df, spec.mandatory + spec.numeric_columns),
        *[domain_check(df, rule) for rule in spec.domains],
        *[range_check(df, rule) for rule in spec.ranges],
    ]


def measure(df: DataFrame, entity: str, checks: Iterable[Check]) -> DataFrame:
    """Report rows of the given checks, all from one aggregation of ``df``."""
    checks = list(checks)
    total = F.count(F.lit(1)).alias("total")
    counts = [
        (F.lit(None) if c.violations is None else c.violations).cast("bigint").alias(f"v{i}")
        for i, c in enumerate(checks)
    ]
    rows = [_report_row(entity, check, F.col(f"v{i}")) for i, check in enumerate(checks)]
    return df.agg(total, *counts).select(F.inline(F.array(*rows)))


def _report_row(entity: str, check: Check, violations: Column) -> Column:
    percent = F.lit(None).cast("double")
    if check.alert_percent is not None:
        share = F.round(violations / F.col("total") * 100, 2)
        percent = F.when(F.col("total") > 0, share).otherwise(F.lit(0.0))
        alert = percent >= check.alert_percent
    else:
        alert = violations > 0
    status = F.when(violations.isNull(), NOT_APPLICABLE).when(alert, ALERT).otherwise(OK)
    return F.struct(
        F.lit(entity).alias("entidade"),
        F.lit(check.rule).alias("regra"),
        F.lit(check.label).alias("coluna"),
        F.col("total").alias("total_registros"),
        violations.alias("violacoes"),
        percent.alias("percentual"),
        status.alias("status"),
    )


def orphan_keys(df: DataFrame, reference: DataFrame, key: ForeignKey) -> DataFrame:
    """Distinct key values without a match; a null key never matches."""
    known = reference.select(F.col(key.target_column).alias(key.column))
    return df.select(key.column).distinct().join(known, key.column, "left_anti")


def foreign_key_check(
    df: DataFrame, entity: str, reference: DataFrame, key: ForeignKey
) -> DataFrame:
    """One report row with the number of orphan key values."""
    orphans = orphan_keys(df, reference, key).agg(F.count(F.lit(1)).alias("v"))
    return orphans.select(
        F.lit(entity).alias("entidade"),
        F.lit(FOREIGN_KEY).alias("regra"),
        F.lit(key.column).alias("coluna"),
        F.lit(None).cast("bigint").alias("total_registros"),
        F.col("v").alias("violacoes"),
        F.lit(None).cast("double").alias("percentual"),
        F.when(F.col("v") > 0, ALERT).otherwise(OK).alias("status"),
    )


def quality_suite(
    df: DataFrame,
    spec: EntitySpec,
    references: Mapping[str, DataFrame] | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """The whole report of one entity.

    Foreign keys are checked when the column exists and the table they point to
    is among ``references``; mandatory columns of the source when it is given.
    """
    references = references or {}
    parts = [measure(df, spec.name, spec_checks(df, spec))]
    if source is not None and spec.mandatory:
        parts.append(source_report(source, spec))
    parts += [
        foreign_key_check(df, spec.name, references[key.entity], key)
        for key in spec.foreign_keys
        if key.column in df.columns and key.entity in references
    ]
    return reduce(DataFrame.unionByName, parts)


def report_documents(report: DataFrame) -> DataFrame:
    """One nested document per entity: overall state and its list of checks.

    The missing-value rows of an entity form a single check with a detail per
    column; any other row is a check of its own. Lists are as long as the spec.
    """
    is_missing = F.col("regra") == MISSING
    checks = (
        report.withColumn("_check", F.when(~is_missing, F.col("coluna")))
        .groupBy("entidade", "regra", "_check")
        .agg(
            F.max("total_registros").alias("total_registros"),
            F.sum("violacoes").alias("violacoes"),
            F.when(F.bool_or(F.col("status") == ALERT), ALERT)
            .when(F.bool_and(F.col("status") == NOT_APPLICABLE), NOT_APPLICABLE)
            .otherwise(OK)
            .alias("status"),
            F.sort_array(
                F.collect_list(
                    F.when(
                        is_missing,
                        F.struct(
                            "coluna",
                            F.col("violacoes").alias("nulos"),
                            F.col("percentual").alias("percentual_nulo"),
                        ),
                    )
                )
            ).alias("detalhe_por_coluna"),
        )
    )
    check = F.struct(
        "regra",
        F.col("_check").alias("coluna"),
        "total_registros",
        "violacoes",
        "status",
        "detalhe_por_coluna",
    )
    return checks.groupBy("entidade").agg(
        overall_status(F.col("status")).alias("status_geral"),
        F.sort_array(F.collect_list(check)).alias("checks"),
    )


def overall_status(status: Column) -> Column:
    """Aggregate: OK only if every check is OK or not applicable."""
    return F.when(F.bool_and(status.isin(OK, NOT_APPLICABLE)), OK).otherwise(ALERT)


def report_status(report: DataFrame) -> DataFrame:
    """Overall state per entity with the number of alerting checks.

    As in the stored documents, the missing-value rows of an entity are one check.
    """
    check = F.struct("regra", F.when(F.col("regra") != MISSING, F.col("coluna")))
    return report.groupBy("entidade").agg(
        overall_status(F.col("status")).alias("status_geral"),
        F.count_distinct(F.when(F.col("status") == ALERT, check)).alias("alertas"),
    )


def gate_decisions(report: DataFrame, fail_on_alert: bool) -> DataFrame:
    """Per entity, whether its table may be published."""
    passes = (F.col("status_geral") == OK) | F.lit(not fail_on_alert)
    return report_status(report).withColumn("publica", passes)


def quality_gate(report: DataFrame, fail_on_alert: bool) -> list[str]:
    """Entities with alerts, for a warning; raises if alerts must stop the job.

    The report holds one row per rule and column, so reading it is safe.
    """
    decisions = gate_decisions(report, fail_on_alert).collect()
    blocked = sorted(row.entidade for row in decisions if not row.publica)
    if blocked:
        raise QualityAlert(f"quality alerts in: {', '.join(blocked)}")
    return sorted(row.entidade for row in decisions if row.status_geral == ALERT)
