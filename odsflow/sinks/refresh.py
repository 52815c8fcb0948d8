"""Stored copies of marts, replaced as a whole or by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odsflow.sinks.paths import numbered, remove


def refresh(mart: DataFrame, path: str) -> int:
    """Write the mart as the next version. Readers keep the last complete version until the
    new one is committed; a failed refresh leaves them where they were."""
    spark = mart.sparkSession
    written = numbered(spark, path, "version", complete=False)
    version = written[-1] + 1 if written else 0
    mart.write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def refresh_days(
    build: Callable[[DataFrame], DataFrame], detail: DataFrame, touched: DataFrame, path: str, day: str = "event_date"
) -> list[dt.date | None]:
    """Recompute the days of a mart that new detail rows touch, and leave the files of all others.

    ``build`` makes the mart from detail rows; both have the column ``day``, and a row of the mart comes
    from detail rows of its own day. ``touched`` are the rows that are new. Only their days are read
    from ``detail``, which prunes its partitions, and only these partitions of ``path`` are replaced.
    Gives the days.
    """
    spark = detail.sparkSession
    days = sorted((r[0] for r in touched.select(day).distinct().collect()), key=lambda d: (d is None, d))  # no more than the calendar has
    if not days:
        return []
    known = [d for d in days if d is not None]
    wanted = F.col(day).isin(known)
    rows = build(detail.where(wanted | F.col(day).isNull() if None in days else wanted))
    (
        rows.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    # Nothing replaces the partition of a day that has no rows any more.
    for gone in set(known) - {r[0] for r in detail.where(wanted).select(day).distinct().collect()}:
        remove(spark, f"{path}/{day}={gone}")
    return days


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version."""
    versions = numbered(spark, path, "version")
    if not versions:
        raise FileNotFoundError(f"{path} has never been refreshed")
    return spark.read.parquet(f"{path}/version={versions[-1]}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    for version in numbered(spark, path, "version")[:-keep]:
        remove(spark, f"{path}/version={version}")
