"""Value cleaning driven by an entity spec.

Each step is one projection over all of its columns instead of one projection
per column, which keeps analysis short on wide tables.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import (
    clean_text,
    lenient_double,
    padded_key,
    target_of_year,
    upper_code,
)
from gaugeworks.spec import WideTarget


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def clean_text_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: clean_text(F.col(c)) for c in _present(df, columns)})


def upper_code_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: upper_code(F.col(c)) for c in _present(df, columns)})


def pad_key_columns(df: DataFrame, keys: Iterable[tuple[str, int]]) -> DataFrame:
    return df.withColumns(
        {
            name: padded_key(F.col(name), df.schema[name].dataType, width)
            for name, width in keys
            if name in df.columns
        }
    )


def parse_number_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns(
        {c: lenient_double(F.col(c), df.schema[c].dataType) for c in _present(df, columns)}
    )


def require_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows where any of the given columns is null."""
    tests = [F.col(c).isNotNull() for c in _present(df, columns)]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def flag_missing(df: DataFrame, columns: Iterable[str], suffix: str) -> DataFrame:
    """Add one boolean per column; the value itself is never imputed."""
    return df.withColumns({c + suffix: F.col(c).isNull() for c in _present(df, columns)})


def resolve_wide_target(df: DataFrame, wide: WideTarget | None) -> DataFrame:
    """Add the target of the row's own year; the wide columns stay."""
    if wide is None or wide.year_column not in df.columns:
        return df
    targets = [(year, F.col(name)) for year, name in wide.columns if name in df.columns]
    if not targets:
        return df
    return df.withColumn(wide.output, target_of_year(F.col(wide.year_column), targets))
