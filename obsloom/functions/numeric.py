"""Numeric expressions: conversions, guarded division, comparison of two sources, narrowing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def c_to_f(column) -> Column:
    """Celsius to Fahrenheit. Operand order is kept so results are bit-equal."""
    return _col(column) * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)


def ieee_div(numerator, denominator) -> Column:
    """Floating division by IEEE rules: x/0 is +-inf and 0/0 is NaN, where ANSI mode would raise."""
    a, b = _col(numerator).cast("double"), _col(denominator).cast("double")
    by_zero = (
        F.when(a.isNull(), F.lit(None).cast("double"))
        .when((a == 0) | F.isnan(a), F.lit(float("nan")))
        .when(a > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )
    return F.when(b == 0, by_zero).otherwise(F.try_divide(a, b))


def guarded_ratio(numerator, denominator) -> Column:
    """``a / b`` as double, null where ``b`` is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def provenance(first, second, labels=("both", "daily", "hourly")) -> Column:
    """Which of two values is present; null when neither is."""
    a, b = _col(first).isNotNull(), _col(second).isNotNull()
    both, only_first, only_second = labels
    return F.when(a & b, both).when(a, only_first).when(b, only_second)


def relative_difference(base, other) -> Column:
    """``(other - base) / base`` where both are present: a fraction, with no guard against zero."""
    a, b = _col(base), _col(other)
    return F.when(a.isNotNull() & b.isNotNull(), ieee_div(b - a, a))


def match_flag(difference, tolerance: float = 0.05) -> Column:
    """0 where the absolute difference reaches ``tolerance``, else 1; a null difference matches."""
    return F.when(F.abs(_col(difference)) >= tolerance, 0).otherwise(1)


def out_of_range(column, low: float, high: float) -> Column:
    """True outside the closed range, null for null."""
    return ~_col(column).between(low, high)


def count_if(condition) -> Column:
    """Number of rows where ``condition`` holds (null counts as not)."""
    return F.count(F.when(_col(condition), 1))


def sum_if(condition) -> Column:
    """Sum of 1 for rows where ``condition`` holds and 0 elsewhere."""
    return F.sum(F.when(_col(condition), 1).otherwise(0))


def rounded_small(column) -> Column:
    """Round half away from zero, then cast to a 16-bit integer; overflow raises."""
    return _checked(F.round(_col(column), 0), -32768, 32767, "smallint")


def rounded_unsigned_small(column) -> Column:
    """Round, then check 0..65535; Spark has no unsigned type, so the result is an int."""
    return _checked(F.round(_col(column), 0), 0, 65535, "int")


def _checked(value: Column, low: int, high: int, type_name: str) -> Column:
    """Cast inside a range and raise outside it, whatever the session's ANSI setting."""
    complaint = F.concat(F.lit(f"value outside {low}..{high}: "), value.cast("string"))
    return (
        F.when(value.isNull() | value.between(low, high), value.cast(type_name))
        .otherwise(F.raise_error(complaint).cast(type_name))
    )
