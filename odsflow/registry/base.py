"""Named queries: a Spark function next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.registry.oracle import with_tables
from odsflow.sources.driver import DriverTables

Build = Callable[[DriverTables], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None

    def run(self, spark: SparkSession, path: str) -> DataFrame:
        return plain_types(self.build(DriverTables(spark, path)))


QUERIES: dict[str, Query] = {}


def add(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function of the driver's tables under ``name``.

    ``sql`` may use any table of ``oracle.TABLES``; what it needs is put in front of it.
    """

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, with_tables(sql) if sql else None)
        return build

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Output types that are the same in both engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType | T.FloatType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegerType | T.ShortType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)
