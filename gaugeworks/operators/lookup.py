"""Decoding codes and attaching directory attributes.

No join carries a broadcast hint: Spark broadcasts a side when its size is known to be
under ``spark.sql.autoBroadcastJoinThreshold``; above that it is a sort-merge join
whose hot keys adaptive execution splits. The labels of a table are computed once and
stored, so their size is known.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.sources.shared import materialise


def code_labels(dictionary: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """(column, code, label) of one table; a repeated code keeps its smallest label."""
    return (
        dictionary.filter((F.col("id_tabela") == table) & F.col("nome_coluna").isin(*columns))
        .groupBy("nome_coluna", "chave")
        .agg(F.min("valor").alias("valor"))
    )


def decode_codes(
    df: DataFrame, dictionary: DataFrame, table: str, columns: Iterable[str]
) -> DataFrame:
    """Replace codes by labels; an unknown code becomes null.

    The codes pass through a generator, which hides from the planner that a column may
    be constant: a join on a constant would have no key and become a nested loop.
    """
    order, columns = df.columns, list(columns)
    labels = materialise(code_labels(dictionary, table, columns), f"labels-{table}")
    rest = [c for c in order if c not in columns]
    codes = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    df = df.select(*rest, F.inline(F.array(codes)))
    for column in columns:
        label = f"{column}_label"
        known = labels.filter(F.col("nome_coluna") == column).select(
            F.col("chave").alias(column), F.col("valor").alias(label)
        )
        df = df.join(known, column, "left").drop(column).withColumnRenamed(label, column)
    return df.select(*order)


def attach_directory(
    df: DataFrame, directory: DataFrame, key: str, directory_key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Left join to the distinct rows of a directory.

    ``columns`` maps directory columns to output columns.
    """
    entries = directory.select(
        F.col(directory_key).alias(key), *[F.col(c).alias(out) for c, out in columns.items()]
    ).distinct()
    return df.join(entries, key, "left").select(*df.columns, *columns.values())
