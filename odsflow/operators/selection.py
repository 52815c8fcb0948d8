"""Reading parts of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odsflow.functions.times import Moment, as_moment, latest, recent


def select_rows(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    where: str | Column | None = None,
    order_by: Sequence[str | Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """Projection, filter, order and limit of one table; the limit is pushed into the sort."""
    rows = table if where is None else table.where(where)
    if order_by:
        rows = rows.orderBy(*order_by)
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(*columns) if columns else rows


def recent_values(
    table: DataFrame, column: str, time_column: str, as_of: Moment | None = None, days: int = 30
) -> DataFrame:
    """Distinct values of a column in the last month: what a filter box offers."""
    return recent(table, time_column, f"{days} DAYS", as_of).select(column).distinct()


def listed_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def retained(
    table: DataFrame, date_column: str, as_of: Moment | None = None, keep_days: int = 7, ahead_days: int = 3
) -> DataFrame:
    """Rows in the daily partitions that are kept: a week back and three days ahead."""
    today = (latest(table, date_column) if as_of is None else as_moment(as_of)).cast("date")
    day = F.col(date_column)
    return table.where((day >= F.date_sub(today, keep_days)) & (day <= F.date_add(today, ahead_days)))
