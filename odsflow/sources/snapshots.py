"""Snapshot loads: CSV folders and JDBC tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.operators.ingest import shift_dates
from odsflow.schemas import CHANGE_FEEDS, CLICK, TIME_COLUMNS, ChangeFeed
from odsflow.sinks.paths import exists

#: Load order: parents before children, events last.
LOAD_ORDER = (*CHANGE_FEEDS, "events")


def csv_schema(source: str) -> T.StructType:
    """Columns of a CSV file: those of the change feed, with times as text."""
    row = CLICK if source == "events" else CHANGE_FEEDS[source].row
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in TIME_COLUMNS else f.dataType) for f in row.fields]
    )


#: Column that takes the line of a row that does not fit the declared types.
_CORRUPT = "_corrupt_line"


def _parsed_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Rows under the names of the source, and the line itself where it could not be read."""
    wanted = csv_schema(source)
    by_name = {f.name: f for f in wanted.fields}
    header = spark.read.option("header", "true").csv(path).columns
    declared = T.StructType([by_name.get(n, T.StructField(n, T.StringType())) for n in header])
    reader = spark.read.option("header", "true").option("enforceSchema", "false").option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", _CORRUPT)
    rows = reader.schema(declared.add(_CORRUPT, T.StringType())).csv(path)
    columns = [F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields]
    # A row counts as bad by the columns that are read, so every query looks at all of them.
    every = F.length(F.concat_ws("", *[F.col(name).cast("string") for name in header])) >= 0
    return rows.where(every).select(*columns, _CORRUPT)


def _as_target(rows: DataFrame, source: str, year_shift: int) -> DataFrame:
    if source == "events":
        # Events keep their time as text, as in the topic.
        if year_shift:
            rows = shift_dates(rows, year_shift).withColumn(
                "created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            )
        return rows
    times = {name: F.try_to_timestamp(name) for name in rows.columns if name in TIME_COLUMNS}
    rows = rows.withColumns(times) if times else rows
    if year_shift:
        rows = shift_dates(rows, year_shift)
    return rows.withColumnsRenamed(CHANGE_FEEDS[source].renames)


def read_csv(spark: SparkSession, path: str, source: str, year_shift: int = 0) -> DataFrame:
    """The good rows of one CSV file or folder with a header, under the names and types of its target table.

    Columns are matched by the header, in any order; a folder whose files have different headers is
    an error when it is read. Rows that do not fit are in ``rejected_csv``.
    """
    parsed = _parsed_csv(spark, path, source)
    return _as_target(parsed.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT), source, year_shift)


def rejected_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Rows with a value of another type, or with too many or too few values, as dead letters: their line, and
    what could be read of it."""
    parsed = _parsed_csv(spark, path, source)
    read = F.to_json(F.struct(*[c for c in parsed.columns if c != _CORRUPT]))
    return parsed.where(F.col(_CORRUPT).isNotNull()).select(
        F.current_timestamp().alias("failed_at"),
        F.col(_CORRUPT).alias("raw_message"),
        F.concat(F.lit(f"not a row of {source}, read as "), read).alias("error_message"),
    )


def load_csv_folder(
    spark: SparkSession,
    folder: str,
    target: str,
    year_shift: int = 0,
    truncate: bool = False,
    skip_events: bool = False,
) -> Iterator[tuple[str, str]]:
    """Load ``<folder>/<source>.csv`` of every source that exists; yields source and path. Rows that do not fit
    go to ``<target>/rejected/<source>``, so that none is lost."""
    for source in LOAD_ORDER:
        file = f"{folder}/{source}.csv"
        if (source == "events" and skip_events) or not exists(spark, file):
            continue
        path = f"{target}/{source}"
        rows = read_csv(spark, file, source, year_shift)
        mode = "overwrite" if truncate else "append"
        rejected_csv(spark, file, source).write.mode(mode).parquet(f"{target}/rejected/{source}")
        rows.write.mode(mode).parquet(path)
        yield source, path


def read_jdbc(
    spark: SparkSession, url: str, feed: ChangeFeed, bounds: tuple[int, int] | None = None, parts: int = 32
) -> DataFrame:
    """Source table over JDBC, in ``parts`` ranges of the key when its bounds are given.

    Filters and projections on the result are pushed to the database. Needs its driver.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", feed.source).option("fetchsize", "10000")
    if bounds is not None:
        reader = (
            reader.option("partitionColumn", feed.key)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(parts))
        )
    return reader.load().withColumnsRenamed(feed.renames)
