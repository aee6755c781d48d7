"""Removing duplicates.

``keep_one`` ranks the rows of a key in a total order and keeps the first. With
``row_number() = 1`` Spark plans a group limit on both sides of the shuffle, so
every task sends at most one row per key: a key that holds a third of all rows
is folded before the exchange and never meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import Literal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.spec import EntitySpec


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One row per distinct row; a hash aggregate with a partial step."""
    return df.distinct()


def keep_one(
    df: DataFrame,
    keys: Iterable[str],
    latest_by: str | None = None,
    never_null: Iterable[str] = (),
    null_keys: Literal["keep", "collapse"] = "keep",
    aside: Iterable[str] = (),
) -> DataFrame:
    """One row per key, the same row on every run.

    The newest row by ``latest_by`` wins; ties, or the whole choice without
    ``latest_by``, are settled by the remaining columns in ascending order, nulls
    first. A row whose key is partly null identifies nothing: such rows only lose
    their exact duplicates, unless ``null_keys="collapse"``. ``never_null`` names
    keys already known to be set, which spares the null test. Columns in ``aside`` are
    no part of a row's value: rows with a partly null key that differ in them only are copies.
    """
    keys, aside = list(keys), list(aside)
    rest = [c for c in df.columns if c not in keys]
    order = []
    if latest_by in rest:
        order.append(F.col(latest_by).desc_nulls_last())
        rest.remove(latest_by)
    order += [F.col(c).asc_nulls_first() for c in rest]

    groups = [F.col(k) for k in keys]
    known = set(never_null)
    nullable = [F.col(k).isNull() for k in keys if k not in known]
    if null_keys == "keep" and nullable and len(keys) < len(df.columns):
        # The whole row becomes part of the key, which also spreads these rows.
        incomplete = reduce(lambda a, b: a | b, nullable)
        others = F.struct(*[F.col(c) for c in df.columns if c not in [*keys, *aside]])
        groups.append(F.when(incomplete, others))

    ranked = Window.partitionBy(*groups).orderBy(*(order or groups))
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def deduplicate(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Drop exact and key duplicates in one pass.

    Without keys, or when the source lacks one of them, only exact duplicates go.
    """
    if spec.dedup_keys and all(k in df.columns for k in spec.dedup_keys):
        return keep_one(df, spec.dedup_keys, spec.latest_by, never_null=spec.mandatory)
    return drop_exact_duplicates(df)


def raw_keys(columns: Iterable[str], spec: EntitySpec) -> list[str]:
    """The dedup keys, if a source has all of them by name and cleaning leaves them as they are.

    A source dealt by them needs no shuffle to drop its duplicates.
    """
    changed = {*spec.text_columns, *spec.code_columns, *spec.numeric_columns}
    changed |= {name for name, _ in spec.padded_keys} | {name for pair in spec.renames for name in pair}
    kept = set(columns) - changed
    return list(spec.dedup_keys) if kept.issuperset(spec.dedup_keys) else []
