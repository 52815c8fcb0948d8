"""Change streams: one query per feed, from topic to keyed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from odsflow.operators import changes
from odsflow.operators.offsets import count_in_span
from odsflow.schemas import CHANGE_FEEDS, DEAD_LETTERS, ChangeFeed
from odsflow.sinks.append import append_batch, read_batches
from odsflow.sinks.keyed_table import KeyedTable
from odsflow.sources.topics import read_topic
from odsflow.streaming.clicks import check_offsets

POSITION = ("partition", "offset")


_PLACES = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])


class ErrorBudgetExceeded(RuntimeError):
    """More rows within a span of a topic were rejected than the feed allows."""


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    feed: ChangeFeed,
    table: KeyedTable,
    dead_letters: str,
    checkpoint: str | None = None,
    contiguous: bool = False,
) -> None:
    """Log the good rows of a batch. Rejected ones are kept first; when they are more than the
    budget the batch is not applied.

    The budget holds for any ``feed.error_span`` offsets in a row, over as many batches as these take.
    With ``contiguous`` a missing offset is an error, and nothing is applied.
    """
    if contiguous:
        check_offsets(batch, batch_id, f"{dead_letters}_offsets", checkpoint)
    envelopes = changes.decode(batch, feed, *POSITION).persist()
    try:
        rejects = envelopes.where(changes.is_rejected(feed))
        bad = rejects.select(
            F.current_timestamp().alias("failed_at"),
            "raw_message",
            F.lit(f"no usable row or key for {feed.table}").alias("error_message"),
        )
        rejected = bad.count()
        if rejected:
            append_batch(bad, dead_letters, batch_id, DEAD_LETTERS.fieldNames(), checkpoint=checkpoint)
        places = f"{dead_letters}_places"
        append_batch(rejects.select(*POSITION), places, batch_id, POSITION, checkpoint=checkpoint)
        if rejected:
            known = read_batches(batch.sparkSession, places, _PLACES, before=batch_id + 1)
            over = count_in_span(known, feed.error_span).where(F.col("in_span") > feed.error_budget)
            worst = over.agg(F.max("in_span")).first()[0]
            if worst:
                raise ErrorBudgetExceeded(f"{feed.table}: batch {batch_id} makes {worst} rejected rows within {feed.error_span} offsets")
        good = envelopes.where(~changes.is_rejected(feed))
        table.append(changes.flatten(good, feed, *POSITION), batch_id, checkpoint)
    finally:
        envelopes.unpersist()


def start_feed(
    messages: DataFrame,
    feed: ChangeFeed,
    table: KeyedTable,
    dead_letters: str,
    checkpoint: str,
    contiguous: bool = False,
    **trigger,
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, feed, table, dead_letters, f"{checkpoint}/{feed.table}", contiguous)

    return (
        messages.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/{feed.table}")
        .trigger(**(trigger or {"processingTime": feed.interval}))
        .start()
    )


def start_all(
    spark: SparkSession,
    servers: str,
    root: str,
    checkpoint: str,
    read: Callable[[SparkSession, str, str, int | None], DataFrame] = read_topic,
    max_offsets: int | None = None,
    contiguous: bool = False,
    **trigger,
) -> dict[str, StreamingQuery]:
    """All feeds, each with its own checkpoint. ``max_offsets`` bounds the messages of a batch instead
    of the feed's own number; 0 stands for no bound."""
    bound = lambda feed: feed.max_rows_per_batch if max_offsets is None else max_offsets or None
    return {
        feed.table: start_feed(
            read(spark, servers, feed.topic, bound(feed)),
            feed,
            keyed_table(spark, root, feed),
            f"{root}/dead_letters/{feed.table}",
            checkpoint,
            contiguous,
            **trigger,
        )
        for feed in CHANGE_FEEDS.values()
    }


def keyed_table(spark: SparkSession, root: str, feed: ChangeFeed) -> KeyedTable:
    return KeyedTable(spark, f"{root}/{feed.table}", feed.target_schema, feed.target_key)
