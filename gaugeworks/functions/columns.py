"""Column expressions for cleaning and comparing values.

All of them are built-in Spark functions, so they stay in generated code and
need no Python worker. Input may be dirty: parsing never raises, it yields null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def clean_text(column: Column) -> Column:
    """Collapse every run of white space to one space, then strip the ends."""
    return F.trim(F.regexp_replace(column, r"\s+", " "))


def upper_code(column: Column) -> Column:
    """Upper-case code; a blank one becomes null, as a partition column would store it."""
    return F.nullif(F.upper(F.trim(column)), F.lit(""))


def _key_text(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, _FRACTIONAL):
        whole = column.try_cast("decimal(38,0)")
        return F.when(column == whole, whole.cast("string"))
    return F.trim(column.cast("string"))


def padded_key(column: Column, data_type: T.DataType, width: int) -> Column:
    """Key as text of exactly ``width`` characters, zeros on the left.

    Empty or over-long keys become null rather than a shortened, wrong key. A
    fractional type is accepted when the value is whole (355030.0).
    """
    text = _key_text(column, data_type)
    return F.when(F.length(text).between(1, width), F.lpad(text, width, "0"))


def absent_key(column: Column) -> Column:
    """Whether there is no key: null or blank."""
    return F.coalesce(F.trim(column.cast("string")) == "", F.lit(True))


def unfit_key(column: Column, data_type: T.DataType, width: int) -> Column:
    """Whether there is a key, but not one of at most ``width`` digits."""
    fit = _key_text(column, data_type).rlike(f"^[0-9]{{1,{width}}}$")
    return ~absent_key(column) & ~F.coalesce(fit, F.lit(False))


def lenient_double(column: Column, data_type: T.DataType) -> Column:
    """Number with decimal comma or point; unparseable text and NaN become null."""
    if isinstance(data_type, T.NumericType):
        number = column.cast("double")
        if not isinstance(data_type, (T.FloatType, T.DoubleType)):
            return number
    else:
        text = column.cast("string")
        number = F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    return F.nullif(number, F.lit(float("nan")))


def target_of_year(year: Column, targets: Iterable[tuple[int, Column]]) -> Column:
    """The target whose year equals the row's year, null for any other year."""
    number = year.try_cast("int")
    choice = None
    for target_year, target in targets:
        start = F if choice is None else choice
        choice = start.when(number == target_year, target)
    return choice


def reached(result: Column, target: Column) -> Column:
    """Three-valued ``result >= target``: null when either side is null."""
    return result >= target


def gap(left: Column, right: Column) -> Column:
    return F.round(left - right, 2)


def _truncated(column: Column) -> Column:
    """Whole part of a double, as a double; doubles from 2 ** 53 on are whole."""
    whole = F.when(column >= 0, F.floor(column)).otherwise(F.ceil(column)).cast("double")
    return F.when(F.abs(column) < 2.0**53, whole).otherwise(column)


def exact_mean(column: Column) -> Column:
    """Mean that does not depend on the order of summation, so any partitioning and any
    task retry give the same result.

    A number is taken apart into its whole part and three steps of 2 ** -60 of what is
    left. Taking apart is exact, whole numbers add up exactly, and only the four sums
    are rounded. The mean is null if a whole part has more than 28 digits or is infinite;
    ``operators.means.grouped_mean`` is right for every double.
    """
    total, rest, unit = None, column, 1.0
    for _ in range(4):
        part = F.sum(_truncated(rest).try_cast("decimal(28,0)")).cast("double") * F.lit(unit)
        total = part if total is None else total + part
        rest = (rest - _truncated(rest)) * F.lit(2.0**60)
        unit *= 2.0**-60
    number = F.count(column)
    fitting = F.count(_truncated(column).try_cast("decimal(28,0)"))
    return F.when(fitting == number, total / F.nullif(number, F.lit(0)))
