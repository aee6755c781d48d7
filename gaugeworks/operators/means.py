"""Means that are right for every double and independent of the order of rows.

A double is a whole number of units of a power of two. It is cut into up to three whole
parts of 32 bits, each counted in units of 2 ** (32 * bin). Parts of a bin add up as
decimals, without rounding, so sums can be made in any order and merged, and only
the total is rounded, once. A group has at most 68 bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 32
LOW, HIGH = -36, 31  # bins of the smallest and the greatest double
CARRY = 4  # bins above for what sums carry over
# Numbers of bins that hold counts instead of parts.
COUNT, NAN, ABOVE, BELOW = 100, 101, 102, 103
_WHOLE = "decimal(38,0)"


def _unit(bin_: Column) -> Column:
    return F.pow(F.lit(2.0), bin_ * WIDTH)


def _truncated(column: Column) -> Column:
    return F.when(column >= 0, F.floor(column)).otherwise(F.ceil(column)).cast("decimal(11,0)")


def _parts(value: Column) -> Column:
    """Array of (bin, part) of a value, with its count; a null counts 0."""
    one, size = F.lit(1), F.abs(value)
    finite = (size > 0) & (size < float("inf"))
    tiny = size < 2.0**-900
    shift = 31  # bins by which tiny values are lifted, so that all units are normal doubles
    lifted = F.when(tiny, value * 2.0 ** (WIDTH * shift)).otherwise(F.when(finite, value))
    # one too high or too low does no harm: parts may be 0, and may have a bit more
    top = F.least(F.floor(F.log2(F.abs(lifted)) / WIDTH).cast("int"), F.lit(HIGH))
    entries, rest = [], lifted
    for step in range(3):
        bin_ = top - step
        part = _truncated(rest / _unit(bin_))
        entries.append((bin_ - F.when(tiny, shift).otherwise(0), part))
        rest = rest - part.cast("double") * _unit(bin_)
    special = (
        F.when(F.isnan(value), NAN).when(value == float("inf"), ABOVE).when(value == float("-inf"), BELOW)
    )
    counted = (F.lit(COUNT), F.when(value.isNotNull(), one).otherwise(0))
    entries = [*[(F.when(finite, b), p) for b, p in entries], (special, one), counted]
    structs = [
        F.struct(b.cast("int").alias("bin"), p.cast("decimal(11,0)").alias("part")) for b, p in entries
    ]
    return F.filter(F.array(*structs), lambda e: e["bin"].isNotNull())


def _carried(bins: Column) -> Column:
    """Digits from 0 to 2 ** 32 - 1 of a number given by its bins, low ones first, and its carry."""
    base = F.lit(2**WIDTH).cast("decimal(11,0)")

    def step(state: Column, bin_: Column) -> Column:
        total = (state["carry"] + bin_).cast(_WHOLE)
        digit = F.pmod(total, base).cast(_WHOLE)
        carry = ((total - digit) / base).cast(_WHOLE)
        return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit)).alias("digits"))

    start = F.struct(
        F.lit(0).cast(_WHOLE).alias("carry"), F.array().cast(f"array<{_WHOLE}>").alias("digits")
    )
    return F.aggregate(bins, start, step)


def _leading(digits: Column) -> Column:
    """(top, low): the three highest digits that are not 0 in front, and the bin of the last of them.

    ``top`` is doubled, and odd if any digit that follows is not 0, which is all that
    rounding to a double needs to know.
    """
    base = F.lit(2**WIDTH).cast("decimal(11,0)")

    def step(state: Column, digit: Column) -> Column:
        begun = (state["used"] > 0) | (digit != 0)
        taken = begun & (state["used"] < 3)
        return F.struct(
            F.when(taken, state["top"] * base + digit).otherwise(state["top"]).cast(_WHOLE).alias("top"),
            (state["used"] + taken.cast("int")).alias("used"),
            (state["low"] - (~begun | taken).cast("int")).alias("low"),
            (state["more"] | (begun & ~taken & (digit != 0))).alias("more"),
        )

    start = F.struct(
        F.lit(0).cast(_WHOLE).alias("top"),
        F.lit(0).alias("used"),
        F.lit(HIGH + CARRY + 1).alias("low"),
        F.lit(False).alias("more"),
    )
    doubled = lambda s: F.struct(
        (s["top"] * 2 + s["more"].cast("int")).cast("decimal(31,0)").cast("double").alias("top"),
        s["low"].alias("low"),
    )
    return F.aggregate(F.reverse(digits), start, step, doubled)


def grouped_mean(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    mean: str = "mean",
    count: str = "count",
    weight: str | None = None,
) -> DataFrame:
    """Mean and number of the non-null values of a group, null and 0 if it has none.

    ``weight`` is a column of whole numbers; a row counts so many times. Infinite values
    and NaN have the effect they have on any sum. The mean is the total, rounded to a
    double, divided by the number, and does not overflow if the total does.
    """
    weighted = F.col("part") if weight is None else F.col("part") * F.col("_weight").cast("decimal(19,0)")
    heads = [*keys, *([] if weight is None else [F.col(weight).alias("_weight")])]
    summed = (
        df.select(*heads, F.col(column).cast("double").alias("_value"))
        .select("*", F.inline(_parts(F.col("_value"))))
        .groupBy(*keys, "bin")
        .agg(F.sum(weighted).cast(_WHOLE).alias("total"))
    )
    totals = summed.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "total"))).alias("_bins")
    )
    zero = F.lit(0).cast(_WHOLE)
    bin_of = lambda b: F.coalesce(F.try_element_at("_bins", b), zero)
    bins = F.transform(F.sequence(F.lit(LOW), F.lit(HIGH + CARRY)), bin_of)
    totals = totals.withColumn("_dense", bins).withColumn("_negative", _carried(F.col("_dense"))["carry"] < 0)
    sized = F.when(F.col("_negative"), F.transform("_dense", lambda v: (-v).cast(_WHOLE))).otherwise(F.col("_dense"))
    totals = totals.withColumn("_top", _leading(_carried(sized)["digits"]))
    power = F.col("_top.low") * WIDTH - 1
    half = F.floor(power / 2)
    number = bin_of(F.lit(COUNT)).cast("long")
    share = F.col("_top.top") / F.nullif(number, F.lit(0))
    size = share * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)
    has = lambda b: bin_of(F.lit(b)) > 0
    result = (
        F.when(has(NAN) | (has(ABOVE) & has(BELOW)), float("nan"))
        .when(has(ABOVE), float("inf"))
        .when(has(BELOW), float("-inf"))
        .when(F.col("_negative"), -size)
        .otherwise(size)
    )
    return totals.select(*keys, F.when(number > 0, result).alias(mean), number.alias(count))
