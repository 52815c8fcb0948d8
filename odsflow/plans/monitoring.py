"""Figures that watch the ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odsflow.functions.measures import mean
from odsflow.functions.times import Moment, recent


def _recent_events(events: DataFrame, interval: str, as_of: Moment | None) -> DataFrame:
    return recent(events, "event_timestamp", interval, as_of, "event_date")


def events_last_hour(events: DataFrame, as_of: Moment | None = None) -> DataFrame:
    return _recent_events(events, "1 HOUR", as_of).agg(F.count(F.lit(1)).alias("value"))


def lag_last_minutes(events: DataFrame, as_of: Moment | None = None) -> DataFrame:
    return _recent_events(events, "5 MINUTES", as_of).agg(
        F.coalesce(mean("event_lag_seconds"), F.lit(0.0)).alias("value")
    )


def dead_letter_count(dead_letters: DataFrame) -> DataFrame:
    return dead_letters.agg(F.count(F.lit(1)).alias("value"))


def events_per_minute(events: DataFrame, as_of: Moment | None = None) -> DataFrame:
    minute = F.date_trunc("minute", F.col("event_timestamp").cast("timestamp"))
    return (
        _recent_events(events, "1 HOUR", as_of)
        .groupBy(minute.alias("time"))
        .agg(F.count(F.lit(1)).alias("value"))
        .orderBy("time")
    )


def events_by_type(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.col("event_type").alias("metric"))
        .agg(F.count(F.lit(1)).alias("value"))
        .orderBy(F.desc("value"), "metric")
    )


def topic_rate(messages: DataFrame) -> DataFrame:
    """Messages per second of each topic, minute by minute."""
    return (
        messages.groupBy("topic", F.window("timestamp", "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("messages"))
        .select("topic", F.col("w.start").alias("minute"), (F.col("messages") / F.lit(60.0)).alias("per_second"))
    )
