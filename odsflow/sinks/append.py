"""Append-only tables fed by micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from odsflow.operators.selection import listed_columns
from odsflow.sinks.owner import claim
from odsflow.sinks.paths import exists

BATCH = "batch_id"


def append_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    checkpoint: str | None = None,
) -> None:
    """Write one batch to a folder of its own. A batch that is replayed replaces itself.

    Batch numbers belong to one checkpoint. With ``checkpoint`` the table is tied to its stream, and
    the batches of any other are refused: they need a new ``path``.
    """
    if checkpoint is not None:
        claim(df.sparkSession, path, checkpoint, path)
    (
        listed_columns(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(f"{path}/{BATCH}={batch_id}")
    )


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All batches written so far, as one table; with ``before``, only those with a lower number."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    rows = spark.read.schema(full).option("basePath", path).parquet(path)
    if before is not None:
        rows = rows.where(rows[BATCH] < before)
    return rows.select(*schema.fieldNames())
