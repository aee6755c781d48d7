"""The cleaning chain applied to every entity, in batch and in streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import absent_key
from gaugeworks.operators.cleaning import (
    clean_text_columns,
    flag_missing,
    pad_key_columns,
    parse_number_columns,
    require_keys,
    resolve_wide_target,
    upper_code_columns,
)
from gaugeworks.operators.dedup import deduplicate
from gaugeworks.operators.naming import normalise_names, rename_columns
from gaugeworks.sources.tables import rebalanced
from gaugeworks.spec import EntitySpec

# Why a row was rejected, also names of rules.
ABSENT_KEY = "chave_ausente"
UNFIT_KEY = "chave_invalida"


def standardise_values(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Names, text, codes, keys and numbers; rows without a mandatory key go.

    Null keys are tested twice: on the raw column, where the test reaches the
    file scan, and on the clean one, since cleaning may turn a key to null.
    """
    return (
        require_keys(named_columns(df, spec), spec.mandatory)
        .transform(clean_text_columns, spec.text_columns)
        .transform(upper_code_columns, spec.code_columns)
        .transform(pad_key_columns, spec.padded_keys)
        .transform(parse_number_columns, spec.numeric_columns)
        .transform(require_keys, spec.mandatory)
    )


def named_columns(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """The source under the column names of the spec."""
    return rename_columns(normalise_names(df), spec.renames)


def rejected_rows(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Source rows that cleaning drops for a mandatory column, one row per source row.

    ``coluna`` is the first such column, ``motivo`` tells a missing value from one
    that does not fit, and ``linha`` holds the source row as JSON. Together with the
    rows that are kept, before duplicates go, they make up the source.
    """
    named = named_columns(df, spec)
    present = [c for c in spec.mandatory if c in named.columns]
    rows = named.select(
        F.to_json(F.struct(*named.columns), {"ignoreNullFields": "false"}).alias("linha"),
        *[F.col(c).cast("string").alias(f"_raw_{c}") for c in present],
        *[F.col(c) for c in present],
    )
    cleaned = (
        rows.transform(clean_text_columns, [c for c in spec.text_columns if c in present])
        .transform(upper_code_columns, [c for c in spec.code_columns if c in present])
        .transform(pad_key_columns, spec.padded_keys)
        .transform(parse_number_columns, [c for c in spec.numeric_columns if c in present])
    )
    column = F.coalesce(
        *[F.when(F.col(c).isNull(), F.lit(c)) for c in present], F.lit(None).cast("string")
    )
    value = F.coalesce(
        *[F.when(F.col("coluna") == c, F.col(f"_raw_{c}")) for c in present],
        F.lit(None).cast("string"),
    )
    return (
        cleaned.withColumn("coluna", column)
        .filter(F.col("coluna").isNotNull())
        .withColumn("valor", value)
        .select(
            F.lit(spec.name).alias("entidade"),
            "coluna",
            F.when(absent_key(F.col("valor")), ABSENT_KEY).otherwise(UNFIT_KEY).alias("motivo"),
            "valor",
            "linha",
        )
    )


def standardise_entity(
    df: DataFrame, spec: EntitySpec, audit: bool = True, rebalance: bool = False
) -> DataFrame:
    """Clean table of one entity.

    The own-year target and the missing flags follow from other columns, so they
    are added after duplicates are gone and never travel through the shuffle. With
    ``rebalance`` neither do they through that of a partitioned write: rows are
    rebalanced for it before these columns are added.
    """
    unique = standardise_values(df, spec).transform(deduplicate, spec)
    if rebalance:
        unique = rebalanced(unique, spec.partition_by)
    result = (
        unique.transform(resolve_wide_target, spec.wide_target)
        .transform(flag_missing, spec.numeric_columns, spec.missing_suffix)
    )
    return result.withColumn(spec.audit_column, F.current_timestamp()) if audit else result
