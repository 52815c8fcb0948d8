"""Preparation of rows before they enter a topic or a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.schemas import CLICK_TOPIC

USER_TOPIC = "new-users"
_TIME_NAMES = ("_at", "_date", "timestamp")


def _filled(rows: DataFrame, column: str) -> Column:
    """Neither missing, nor the number zero, nor empty text; the text "0" is a value."""
    kind = rows.schema[column].dataType
    empty = F.lit("") if isinstance(kind, T.StringType) else F.lit(0).cast(kind)
    return F.coalesce(F.col(column) != empty, F.lit(False))


def normalise_clicks(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Clicks marked ``accepted`` or not; a missing time becomes the present."""
    text = F.nullif(F.col("created_at"), F.lit(""))
    return (
        rows.withColumn("accepted", _filled(rows, "id") & _filled(rows, "session_id"))
        .withColumn("created_at", F.coalesce(text, _iso(now)))
        .withColumn("key", F.col("session_id"))
    )


def normalise_users(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Users marked ``accepted`` or not; both times are set when the first is missing."""
    missing = F.coalesce(F.col("created_at"), F.lit("")) == ""
    return rows.withColumns(
        {
            "accepted": _filled(rows, "id"),
            "created_at": F.when(missing, _iso(now)).otherwise(F.col("created_at")),
            "updated_at": F.when(missing, _iso(now)).otherwise(F.col("updated_at")),
            "key": F.col("id").cast("string"),
        }
    )


def to_topic(normalised: DataFrame, topic: str = CLICK_TOPIC) -> DataFrame:
    """Accepted rows as messages."""
    body = [c for c in normalised.columns if c not in ("accepted", "key")]
    return normalised.where("accepted").select(
        "key", F.to_json(F.struct(*body)).cast("binary").alias("value"), F.lit(topic).alias("topic")
    )


def acceptance(normalised: DataFrame) -> DataFrame:
    return normalised.agg(
        F.count_if(F.col("accepted")).alias("accepted"), F.count_if(~F.col("accepted")).alias("failed")
    )


def _iso(now: Column | None) -> Column:
    moment = F.current_timestamp() if now is None else now
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def shift_dates(df: DataFrame, years: int) -> DataFrame:
    """Every column named like a time, moved by whole years; text that is no time becomes null.

    A 29 February lands on the 28th where the year has no 29th.
    """
    moved = {}
    for name, kind in df.dtypes:
        if any(part in name for part in _TIME_NAMES):
            value = F.try_to_timestamp(name) if kind == "string" else F.col(name)
            if kind == "date":
                value = value.cast("timestamp_ntz")
            moved[name] = value + F.make_ym_interval(F.lit(years), F.lit(0))
    return df.withColumns(moved) if moved else df
