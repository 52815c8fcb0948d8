"""Date ranges and recency filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Moment = str | dt.date | dt.datetime | Column


def as_moment(value: Moment) -> Column:
    """A column for a parameter. Literals carry no zone so that they match either timestamp type."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def latest(df: DataFrame, column: str) -> Column:
    """Largest value of a column, as a scalar subquery: Spark runs it first and uses the
    result as a constant, so a filter built on it still reaches the scan."""
    return df.agg(F.max(column)).scalar()


def recent(
    df: DataFrame, column: str, interval: str, as_of: Moment | None = None, date_column: str | None = None
) -> DataFrame:
    """Rows of the last ``interval`` before ``as_of`` (the newest row when not given).

    ``date_column`` names the partition column, the day of ``column``; bounding it too is what
    prunes partitions, and the newest row is looked for in the newest partition only.
    """
    back = F.expr(f"INTERVAL {interval}")
    newest = df
    if as_of is None and date_column:
        newest = df.where(F.col(date_column) == latest(df, date_column))
    # The subtraction is part of the subquery: a bare subquery is what the scan can push down.
    start = newest.agg(F.max(column) - back).scalar() if as_of is None else as_moment(as_of) - back
    kept = df.where(F.col(column) >= start)
    if date_column:
        kept = kept.where(F.col(date_column) >= start.cast("date"))
    return kept


def in_range(
    df: DataFrame, column: str, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Rows with ``start <= column < end``; a missing bound is open."""
    if start is not None:
        df = df.where(F.col(column) >= as_moment(start))
    if end is not None:
        df = df.where(F.col(column) < as_moment(end))
    return df


def days_between(start: str | Column, end: str | Column) -> Column:
    """Calendar days from ``start`` to ``end``: midnight passed counts as one."""
    return F.datediff(end, start)


def whole_units_between(unit: str, start: str | Column, end: str | Column) -> Column:
    """Complete units of time (SECOND, DAY, ...) from ``start`` to ``end``."""
    return F.timestamp_diff(unit, _col(start), _col(end))


def local_hour(column: str | Column, zone: str) -> Column:
    """Hour of day in ``zone`` of a UTC time."""
    return F.hour(F.from_utc_timestamp(_col(column).cast("timestamp"), zone))


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
