"""Physical layout of large tables: daily partitions, filters, and buckets for joins."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.operators.joins import scan_bytes
from odsflow.sinks.append import BATCH
from odsflow.sinks.paths import numbered, numbered_dates, remove

BLOOM_COLUMNS = ("session_id", "user_id")


def write_daily(
    events: DataFrame, path: str, bloom_columns: tuple[str, ...] = BLOOM_COLUMNS, whole: bool = False
) -> None:
    """Write events by day, in time order within files.

    ``rebalance`` sizes the files by what a day holds: a heavy day is split over several
    tasks, light days share one. Bloom filters let point lookups skip row groups. Days that
    are not among the events stay as they are, unless the ``whole`` table is replaced.
    """
    writer = (
        events.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "event_timestamp")
        .write.mode("overwrite")
        .partitionBy("event_date")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
    )
    for column in bloom_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


#: Ranks of each column in a clustered layout: six bits.
RANKS = 64


def _rank(bounds: list, value: Column) -> Column:
    """How many of the ascending bounds are below a value; 0 for null."""
    if not bounds:
        return F.lit(0).cast("long")
    below = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda bound: bound < value)
    return F.size(below).cast("long")


def _as_number(column: str, kind: T.DataType, least, most) -> Column:
    """A number in the order of the column's values. All texts between ``least`` and ``most`` begin alike; of
    what follows, six bytes count."""
    if isinstance(kind, T.StringType):
        begin = len(os.path.commonprefix([(least or "").encode(), (most or "").encode()]))
        head = F.hex(F.substring(F.encode(F.col(column), "UTF-8"), begin + 1, 6))
        return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")
    timed = isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType)
    return (F.col(column).cast("timestamp") if timed else F.col(column)).cast("double")


def clustered(df: DataFrame, columns: Sequence[str], name: str = "cell") -> DataFrame:
    """``df`` with the cell of each row on a curve through all ``columns``, from the interleaved bits of their ranks.

    Rows close on the curve are close in every column, so that files cut along it have narrow ranges of
    each of them, and a filter on any one skips most files. Ranks come from quantiles of the data,
    which are computed first and are ``RANKS`` numbers a column.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ends = df.agg(*[f(c) for c in columns for f in (F.min, F.max)]).first()
    numbers = {c: _as_number(c, kinds[c], ends[2 * i], ends[2 * i + 1]) for i, c in enumerate(columns)}
    shares = F.array(*[F.lit(i / RANKS) for i in range(1, RANKS)])
    cell = F.lit(0).cast("long")
    found = df.agg(*[F.percentile_approx(numbers[c], shares) for c in columns]).first()
    for place, column in enumerate(columns):
        rank = _rank(sorted(set(found[place] or [])), numbers[column])
        for bit in range(RANKS.bit_length() - 1):
            part = F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + place)
            cell = cell.bitwiseOR(part)
    return df.withColumn(name, cell)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """Write ``files`` files cut along the curve of ``columns``; sorted within, so row groups are narrow too."""
    cells = clustered(df, columns, "_cell")
    spread = cells.repartitionByRange(files, "_cell", *columns).sortWithinPartitions("_cell", *columns).drop("_cell")
    spread.write.mode("overwrite").parquet(path)


def drop_expired_days(spark: SparkSession, path: str, today: dt.date, keep_days: int = 7) -> list[dt.date]:
    """Remove the partitions of days older than ``keep_days``; data files are not opened."""
    expired = [
        day
        for day in numbered_dates(spark, path, "event_date")
        if day < today - dt.timedelta(days=keep_days)
    ]
    for day in expired:
        remove(spark, f"{path}/event_date={day}")
    return expired


def drop_expired_batches(spark: SparkSession, path: str, today: dt.date, keep_days: int = 7) -> list[dt.date]:
    """The same for a table whose batches have a folder each, with days inside."""
    gone: set[dt.date] = set()
    for batch in numbered(spark, path, BATCH):
        gone.update(drop_expired_days(spark, f"{path}/{BATCH}={batch}", today, keep_days))
    return sorted(gone)


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Keys that hold more than ``share`` of all rows. There are at most ``1 / share``."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counted.where(F.col("n") > F.lit(share) * total).select(key)


class ColocatedPair:
    """A large table and its parent, bucketed alike so that joining them moves no rows.

    A key that holds a large share of the child would make one bucket, and so one task, too
    heavy. Rows of such keys, and rows without a key, are kept in a table without buckets
    instead, and joined to their few parent rows by broadcast.

    A bucket is read by one task, so without ``buckets`` their number follows from the size of the
    child's files, ``bucket_bytes`` for each.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        path: str,
        key: str,
        buckets: int | None = None,
        bucket_bytes: int = 128 << 20,
    ):
        self.spark, self.name, self.path, self.key = spark, name, path, key
        self.buckets, self.bucket_bytes = buckets, bucket_bytes

    def write(self, child: DataFrame, parent: DataFrame, share: float = 0.01) -> None:
        # The child may be a plan of its own; it is computed once.
        child.write.mode("overwrite").parquet(f"{self.path}/staged")
        child = self.spark.read.parquet(f"{self.path}/staged")
        buckets = self.buckets or -(-(scan_bytes(child) or 0) // self.bucket_bytes) or 1
        hot_path = f"{self.path}/hot_keys"
        hot_keys(child, self.key, share).coalesce(1).write.mode("overwrite").parquet(hot_path)
        hot = F.broadcast(self.spark.read.parquet(hot_path))
        has_key = F.col(self.key).isNotNull()
        apart = child.where(has_key).join(hot, self.key, "left_semi").unionByName(child.where(~has_key))
        apart.write.mode("overwrite").parquet(f"{self.path}/child_hot")
        self._write_bucketed(child.where(has_key).join(hot, self.key, "left_anti"), "child", buckets)
        self._write_bucketed(parent, "parent", buckets)
        remove(self.spark, f"{self.path}/staged")

    def join(self, how: str = "left") -> DataFrame:
        """Child rows with their parent (``left`` or ``inner``)."""
        parent = self.spark.table(f"{self.name}_parent")
        hot = F.broadcast(self.spark.read.parquet(f"{self.path}/hot_keys"))
        hot_parent = F.broadcast(parent.join(hot, self.key, "left_semi"))
        heavy = self.spark.read.parquet(f"{self.path}/child_hot").join(hot_parent, self.key, how)
        return self.bucketed_join(how).unionByName(heavy)

    def bucketed_join(self, how: str = "left") -> DataFrame:
        """The part of the join that runs bucket by bucket. The hint keeps a parent that looks
        small from being sent to every task."""
        child, parent = self.spark.table(f"{self.name}_child"), self.spark.table(f"{self.name}_parent")
        return child.join(parent.hint("merge"), self.key, how)

    def drop(self) -> None:
        for part in ("child", "parent"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{part}")

    def _write_bucketed(self, df: DataFrame, part: str, buckets: int) -> None:
        # One task per bucket, so that a bucket is one file per write and not one per task.
        (
            df.repartition(buckets, self.key)
            .write.mode("overwrite")
            .option("path", f"{self.path}/{part}")
            .bucketBy(buckets, self.key)
            .sortBy(self.key)
            .saveAsTable(f"{self.name}_{part}")
        )
