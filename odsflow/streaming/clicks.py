"""Click stream: valid events to the detail table, the rest to the dead letters."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from odsflow.operators import clicks
from odsflow.operators.joins import lookup_join
from odsflow.operators.offsets import extents, missing_offsets
from odsflow.schemas import DEAD_LETTERS, EVENTS
from odsflow.sinks.append import append_batch, read_batches


def start_valid(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = clicks.WATERMARK,
    products: Callable[[], DataFrame] | None = None,
    **trigger,
) -> StreamingQuery:
    """Parse, check, deduplicate, enrich and append.

    With ``products`` each batch is also joined to the product table that the function gives at
    that time, which adds ``product_category``.
    """
    stream = clicks.deduplicate(clicks.valid(clicks.parse(messages)), watermark)
    columns = EVENTS.fieldNames()

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, names = clicks.enrich(batch), list(columns)
        if products is not None:
            rows = with_category(rows, products())
            names.append("product_category")
        append_batch(rows, path, batch_id, names, ["event_date"], f"{checkpoint}/valid-events")

    return _start(stream, write, checkpoint, "valid-events", trigger or {"processingTime": "5 seconds"})


def start_dead_letters(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append rejected messages. A query of its own: only the valid side keeps state."""
    stream = clicks.parse(messages)

    def write(batch: DataFrame, batch_id: int) -> None:
        columns = DEAD_LETTERS.fieldNames()
        append_batch(clicks.dead_letters(batch), path, batch_id, columns, checkpoint=f"{checkpoint}/dead-letters")

    return _start(stream, write, checkpoint, "dead-letters", trigger or {"processingTime": "10 seconds"})


def with_category(events: DataFrame, products: DataFrame) -> DataFrame:
    """Stream–static join: category of the product, null where there is none."""
    names = products.select("product_id", F.col("category").alias("product_category"))
    return lookup_join(events, names, "product_id")


def window_counts(events: DataFrame, length: str = "5 minutes") -> DataFrame:
    """Five-minute counts of a stream that has a watermark, final once it has passed the window.

    A stream cannot count distinct values exactly without keeping them all, so the distinct
    counts are approximate here; the batch summary is exact.
    """
    return (
        events.groupBy(F.window("event_timestamp", length).alias("w"), "traffic_source", "browser", "event_type", "page_type")
        .agg(
            F.count("event_id").alias("total_events"),
            F.approx_count_distinct("session_id").alias("approx_sessions"),
            F.approx_count_distinct("user_id").alias("approx_users"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "traffic_source",
            "browser",
            "event_type",
            "page_type",
            "total_events",
            "approx_sessions",
            "approx_users",
        )
    )


class LateRows(StreamingQueryListener):
    """Counts, per query, the rows dropped because they were older than the watermark.

    A query itself remembers its last progress reports only; the listener adds up all of them.
    """

    def __init__(self):
        self.dropped: Counter[str] = Counter()
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[str(progress.id)] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def count_late(spark: SparkSession) -> LateRows:
    """Count late rows of all queries that start from now on."""
    late = LateRows()
    spark.streams.addListener(late)
    return late


def start_window_counts(
    messages: DataFrame, path: str, checkpoint: str, watermark: str = clicks.WATERMARK, **trigger
) -> StreamingQuery:
    """Append the counts of every window that is final.

    Two states in one query: messages are deduplicated first, so that one that is delivered again is
    counted once, then counted by window. Both use the same watermark.
    """
    stream = window_counts(clicks.enrich(clicks.deduplicate(clicks.valid(clicks.parse(messages)), watermark)))

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_id, batch.columns, checkpoint=f"{checkpoint}/window-counts")

    return _start(stream, write, checkpoint, "window-counts", trigger or {"processingTime": "1 minute"})


#: What is kept of a batch for those after it.
_TIMES = T.StructType([T.StructField("newest", T.TimestampType())])
_LATE = T.StructType([*DEAD_LETTERS.fields, T.StructField("id", T.LongType()), T.StructField("event_timestamp", T.TimestampType())])
TOO_LATE = "older than the watermark"


def start_late_rows(
    messages: DataFrame, path: str, checkpoint: str, watermark: str = clicks.WATERMARK, **trigger
) -> StreamingQuery:
    """Keep the valid messages that come later than the watermark allows, which a stateful query drops.

    A message is late if it is no newer than the newest one of all earlier batches less ``watermark``.
    The newest time of each batch is kept beside the rows, so a batch that is replayed finds the same.
    """
    stream = clicks.parse(messages).where(clicks.accepted())

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, times = batch.sparkSession, f"{path}_times"
        seen = read_batches(spark, times, _TIMES, before=batch_id).agg(F.max("newest").alias("newest")).first()["newest"]
        # Without an earlier batch nothing is late.
        bound = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
        late = batch.where(F.unix_millis(F.col("event_timestamp").cast("timestamp")) <= F.unix_millis(bound))
        rows = late.select(
            F.current_timestamp().alias("failed_at"),
            "raw_message",
            F.lit(TOO_LATE).alias("error_message"),
            F.col("data.id").alias("id"),
            F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
        )
        append_batch(rows, path, batch_id, _LATE.fieldNames(), checkpoint=f"{checkpoint}/late-rows")
        newest = batch.agg(F.max(F.col("event_timestamp").cast("timestamp")).alias("newest"))
        append_batch(newest, times, batch_id, ["newest"], checkpoint=f"{checkpoint}/late-rows")

    return _start(stream, write, checkpoint, "late-rows", trigger or {"processingTime": "5 seconds"})


def late_rows(spark: SparkSession, path: str, events: DataFrame | None = None) -> DataFrame:
    """Late messages; with the detail table, only those that are not in it. A query with other batches
    may have taken one in time, and a late copy of a message that was in time is no loss."""
    late = read_batches(spark, path, _LATE)
    if events is None:
        return late
    taken = events.select(F.col("event_id").alias("id"), F.col("event_timestamp").cast("timestamp").alias("event_timestamp"))
    return late.join(taken, ["id", "event_timestamp"], "left_anti")


class LostMessages(RuntimeError):
    """Offsets of a topic are missing."""


def start_offsets(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Watch the offsets of a topic whose messages are numbered without gaps; a gap ends the query."""

    def write(batch: DataFrame, batch_id: int) -> None:
        check_offsets(batch, batch_id, path, f"{checkpoint}/offsets")

    return _start(messages.select("topic", "partition", "offset"), write, checkpoint, "offsets", trigger or {"processingTime": "5 seconds"})


_LAST = T.StructType(
    [T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("last", T.LongType())]
)


def check_offsets(batch: DataFrame, batch_id: int, path: str, checkpoint: str | None = None) -> None:
    """Raise if offsets are missing within the batch or between it and those before. Otherwise the last
    offset of every partition is kept at ``path`` for the batches to come."""
    spark = batch.sparkSession
    seen = read_batches(spark, path, _LAST, before=batch_id).groupBy("topic", "partition").agg(F.max("last").alias("last"))
    gaps = missing_offsets(batch, seen).orderBy("topic", "partition", "first_missing").limit(10).collect()
    if gaps:
        raise LostMessages("; ".join(f"{g.topic}/{g.partition}: {g.first_missing} to {g.last_missing}" for g in gaps))
    append_batch(extents(batch), path, batch_id, _LAST.fieldNames(), checkpoint=checkpoint)


def _start(stream: DataFrame, write, checkpoint: str, name: str, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**trigger)
        .start()
    )
