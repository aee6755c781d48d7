"""Quality reports that are merged from the reports of parts, without reading the rows again.

Counts of violations add up over parts of a table. The exception is the number of
different keys: a key of two parts counts once. So these are counted over the keys of all
parts, and duplicates are the complete rows less the different keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.quality import (
    ALERT,
    DUPLICATES,
    INCOMPLETE,
    MISSING,
    MISSING_ALERT_PERCENT,
    NOT_APPLICABLE,
    OK,
)
from gaugeworks.operators.standardise import ABSENT_KEY

BUCKET = "_bucket"


def has_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    return bool(keys) and all(k in df.columns for k in keys)


def key_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by its key; a row without a whole key goes by all of its columns."""
    every = F.pmod(F.xxhash64(*df.columns), F.lit(buckets))
    if not has_keys(df, keys):
        return every.cast("int")
    by_key = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(complete, by_key).otherwise(every).cast("int")


def merged_report(reports: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """The report on all parts together, as ``quality_suite`` gives it on the whole table.

    ``keys`` has the key columns of all parts; a row of each different key is enough.
    """
    summed = reports.groupBy("entidade", "regra", "coluna").agg(
        F.sum("total_registros").alias("total_registros"), F.sum("violacoes").alias("violacoes")
    )
    if keys is not None:
        rule = ["regra", "coluna"]
        # the rule on incomplete keys has the same columns, so it counts the complete rows
        complete = summed.filter(F.col("regra") == INCOMPLETE).select(
            F.lit(DUPLICATES).alias("regra"),
            "coluna",
            (F.col("total_registros") - F.col("violacoes")).alias("_repeated"),
        )
        # count_distinct of several columns skips rows with a null among them
        different = keys.agg((-F.count_distinct(*keys.columns)).alias("_repeated")).select(
            F.lit(DUPLICATES).alias("regra"), F.lit(",".join(keys.columns)).alias("coluna"), "_repeated"
        )
        counted = complete.unionByName(different).groupBy(*rule).agg(F.sum("_repeated").alias("_repeated"))
        summed = summed.join(counted, rule, "left").select(
            "entidade", *rule, "total_registros", F.coalesce("_repeated", "violacoes").alias("violacoes")
        )
    by_share = F.col("regra").isin(MISSING, INCOMPLETE, ABSENT_KEY)
    share = F.round(F.col("violacoes") / F.col("total_registros") * 100, 2)
    percent = F.when(by_share, F.when(F.col("total_registros") > 0, share).otherwise(0.0))
    alert = F.when(by_share, percent >= MISSING_ALERT_PERCENT).otherwise(F.col("violacoes") > 0)
    status = F.when(F.col("violacoes").isNull(), NOT_APPLICABLE).when(alert, ALERT).otherwise(OK)
    return summed.withColumn("percentual", percent).withColumn("status", status)
