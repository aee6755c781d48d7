"""Totals along an order inside groups of any size, without a task per group."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Literal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import arrow_schema
from gaugeworks.sources.shared import materialise


def running_totals(
    rows: DataFrame,
    group: str,
    order: list[str],
    totals: Mapping[str, str],
    combine: Literal["sum", "xor"] = "sum",
    name: str = "running",
) -> DataFrame:
    """``rows`` with, for each (new column, column) of ``totals``, the total up to the row itself.

    ``group`` and the columns to total are longs without nulls. Rows are dealt out by
    range of group and order, so a large group lies in many tasks, each of which totals
    its own part; what earlier parts hold is added from a table with one row per group
    and part. Rows that agree in group and order follow each other in any order.
    """
    part, tie = f"{name}_part", f"{name}_tie"
    keys = [group, *order, tie]
    ordered = (
        rows.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(tie)
    )
    schema = ordered.select("*", *[F.col(c).alias(n) for n, c in totals.items()], F.lit(0).alias(part)).schema
    arrow = arrow_schema(schema)
    at, columns = rows.columns.index(group), [rows.columns.index(c) for c in totals.values()]
    xor = combine == "xor"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        last, carried = None, [np.int64(0)] * len(columns)
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(at).to_numpy()
            first = np.ones(len(groups), bool)
            first[1:] = groups[1:] != groups[:-1]
            starts = np.flatnonzero(first)
            lengths = np.diff(np.append(starts, len(groups)))
            out = list(batch.columns)
            for i, column in enumerate(columns):
                value = batch.column(column).to_numpy()
                if xor:
                    total = np.bitwise_xor.accumulate(value)
                    total ^= np.repeat(total[starts] ^ value[starts], lengths)
                else:
                    total = np.cumsum(value)
                    total -= np.repeat(total[starts] - value[starts], lengths)
                if groups[0] == last:
                    head = total[: lengths[0]]
                    total[: lengths[0]] = head ^ carried[i] if xor else head + carried[i]
                carried[i] = total[-1]
                out.append(pa.array(total))
            last = groups[-1]
            out.append(pa.array(np.full(len(groups), number, np.int32)))
            yield pa.RecordBatch.from_arrays(out, schema=arrow)

    local = materialise(ordered.mapInArrow(run, schema), name)
    add = F.bit_xor if xor else F.sum
    parts = local.groupBy(group, part).agg(*[add(c).alias(n) for n, c in totals.items()])
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # only groups that lie in several parts have rows here, at most two per part
    before = (
        parts.select(group, part, *[add(n).over(earlier).alias(f"{name}_{n}") for n in totals])
        .where(F.col(f"{name}_{next(iter(totals))}").isNotNull())
    )
    joined = local.join(materialise(before, f"{name}-before"), [group, part], "left")
    for n in totals:
        carry = F.coalesce(F.col(f"{name}_{n}"), F.lit(0))
        joined = joined.withColumn(n, F.col(n).bitwiseXOR(carry) if xor else F.col(n) + carry)
    return joined.select(*rows.columns, *totals)
