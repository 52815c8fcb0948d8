"""From change envelopes to rows of keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.functions.decoding import decode_once
from odsflow.schemas import TIME_COLUMNS, ChangeFeed

DELETED = "is_deleted"
VERSION = "version"


def _envelope(row: T.StructType) -> T.StructType:
    inner = [
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
    return T.StructType([T.StructField("payload", T.StructType(inner)), *inner])


def decode(messages: DataFrame, feed: ChangeFeed, *keep: str) -> DataFrame:
    """Envelopes as ``before``, ``after``, ``op``; with or without a ``payload`` around them.

    Tombstones (no value) are dropped. ``keep`` names topic columns to carry along.
    """
    decoded = (
        messages.where(F.col("value").isNotNull())
        .select(*keep, F.col("value").cast("string").alias("raw_message"))
        .select(*keep, "raw_message", decode_once("raw_message", _envelope(feed.row), "w"))
    )
    parts = [
        F.coalesce(F.col(f"w.payload.{name}"), F.col(f"w.{name}")).alias(name)
        for name in ("before", "after", "op", "ts_ms")
    ]
    return decoded.select(*keep, "raw_message", *parts)


def is_rejected(feed: ChangeFeed) -> Column:
    """Envelopes without either image, or without a key in the images they have."""
    return F.coalesce(F.col(f"after.{feed.key}"), F.col(f"before.{feed.key}")).isNull()


def flatten(envelopes: DataFrame, feed: ChangeFeed, *keep: str) -> DataFrame:
    """One row per change: the new image, or the old one for a delete.

    The key comes from whichever image has it: a delete may carry nothing else. Renames and
    time conversions of the feed are applied.
    """
    deleted = F.coalesce(F.col("op") == "d", F.lit(False))
    image = F.when(deleted, F.col("before")).otherwise(F.col("after"))
    columns = []
    for field in feed.row.fields:
        value = image[field.name]
        if field.name == feed.key:
            value = F.coalesce(F.col(f"after.{field.name}"), F.col(f"before.{field.name}"))
        elif field.name in TIME_COLUMNS:
            value = _to_time(value, field.dataType)
        columns.append(value.alias(feed.renames.get(field.name, field.name)))
    present = F.col("before").isNotNull() | F.col("after").isNotNull()
    return envelopes.where(present).select(*keep, *columns, deleted.cast("int").alias(DELETED))


def _to_time(value: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(value) if isinstance(kind, T.LongType) else F.try_to_timestamp(value)


def rejected_per_batch(envelopes: DataFrame, feed: ChangeFeed, batch: str) -> DataFrame:
    """Rejected rows of each batch and whether they exceed the feed's budget."""
    return (
        envelopes.groupBy(batch)
        .agg(F.count_if(is_rejected(feed)).alias("rejected"), F.count(F.lit(1)).alias("total"))
        .withColumn("over_budget", F.col("rejected") > feed.error_budget)
    )
