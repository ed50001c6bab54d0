"""Casts and divisions that give null instead of failing under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(text: Column, type_name: str = "bigint") -> Column:
    """Text to integer: fractions are cut off (``12.7`` is 12), anything else that is no number is null."""
    leading_digits = F.regexp_extract(text, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(text.try_cast(type_name), leading_digits.try_cast(type_name))


def money(text: Column) -> Column:
    return text.try_cast("decimal(10,2)")


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, null when the divisor is zero."""
    return F.try_divide(part, whole)


def decimal_average(total: Column, count: Column, type_name: str) -> Column:
    """The average of a decimal(10,2) column from its sum and count.

    Spark's own ``avg`` rounds to six places first and the result is then cast to two, so both
    roundings are repeated here to get the same cents from pre-aggregated sums.
    """
    return ratio(total.cast("decimal(20,2)"), count.cast("decimal(20,0)")).cast("decimal(24,6)").cast(type_name)


def sum_if(condition: Column, value: Column) -> Column:
    """Conditional sum, the building block of a pivot to fixed columns."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))
