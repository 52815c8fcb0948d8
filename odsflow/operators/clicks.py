"""From raw click messages to detail rows and dead letters.

Every function works the same on a batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odsflow.functions import clicks as c
from odsflow.functions.decoding import decode_once
from odsflow.schemas import BAD_FIELDS, BAD_JSON, BAD_TIME, CLICK, EVENTS

WATERMARK = "10 minutes"
DEDUP_KEYS = ["id", "event_timestamp"]


def parse(messages: DataFrame) -> DataFrame:
    """Messages with a value, decoded: ``raw_message``, ``data`` and ``event_timestamp``."""
    text = F.col("value").cast("string")
    return (
        messages.where(F.col("value").isNotNull())
        .select(text.alias("raw_message"))
        .select("raw_message", decode_once("raw_message", CLICK, "data"))
        .withColumn("event_timestamp", F.try_to_timestamp("data.created_at"))
    )


def accepted() -> Column:
    """Whether a parsed message is valid."""
    # A time that cannot be read would leave the row without a partition, and its
    # deduplication state without an end.
    return c.is_valid("data") & F.col("event_timestamp").isNotNull()


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(accepted()).select("data.*", "event_timestamp")


def dead_letters(parsed: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Rejected messages and the reason."""
    reason = (
        F.when(~c.is_json("raw_message"), BAD_JSON)
        .when(~c.is_valid("data"), BAD_FIELDS)
        .otherwise(BAD_TIME)
    )
    return parsed.where(~accepted()).select(
        (F.current_timestamp() if failed_at is None else failed_at).alias("failed_at"),
        "raw_message",
        reason.alias("error_message"),
    )


def deduplicate(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """One row per id and time. On a stream, rows older than the watermark are dropped and
    the state they needed is given up; on a batch the watermark has no effect."""
    if events.isStreaming:
        events = events.withWatermark("event_timestamp", watermark)
    return events.dropDuplicates(DEDUP_KEYS)


def enrich(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Detail rows: page type and product from the address, dates, flags and lag."""
    now = F.current_timestamp() if ingested_at is None else ingested_at
    time = F.col("event_timestamp")
    made = {
        "event_id": F.col("id"),
        "event_date": time.cast("date"),
        "ingested_at": now,
        "page_type": c.page_type(F.col("uri")),
        "product_id": c.product_id(F.col("uri")),
        "is_conversion": F.col("event_type") == "purchase",
        "processing_time": now,
        "event_lag_seconds": now.cast("timestamp").cast("double") - time.cast("timestamp").cast("double"),
    }
    return events.select(*[made.get(n, F.col(n)).alias(n) for n in EVENTS.fieldNames()])
