"""Aggregate and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    """Number of rows where ``condition`` holds."""
    return F.sum(F.when(condition, 1).otherwise(0))


def any_where(condition: Column) -> Column:
    """True when ``condition`` holds for at least one row; never null."""
    return F.coalesce(F.bool_or(condition), F.lit(False))


def mean(column: str | Column) -> Column:
    """Average as a double. Exact up to the last division when the input is a decimal."""
    return ratio(F.sum(column), F.count(column))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null when the denominator is zero."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.nullif(bottom, F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    """``ratio`` in percent."""
    return ratio(numerator, denominator) * F.lit(100)
