"""Numeric guards. ANSI mode raises on division by zero, so every division goes through here."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is 0."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    return F.round(divide(part, whole) * 100, 4)


def clean_double(column: Column) -> Column:
    """Text or number to DOUBLE; unparsable and NaN become NULL."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def zero_as_null(column: Column) -> Column:
    return F.nullif(column, F.lit(0.0))


def exact_mean(column: Column) -> Column:
    """Mean whose sum is kept in decimal, so it does not depend on row order or partitioning."""
    total = F.sum(column.cast("decimal(28,8)")).cast("double")
    return divide(total, F.count(column))
