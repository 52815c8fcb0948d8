"""Expressions over click events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from odsflow.schemas import EVENT_TYPES

_REQUIRED = ("id", "session_id", "event_type", "created_at")


def _uri_parts(uri: Column) -> Column:
    # One slash is taken off each end, not all of them.
    return F.split(F.regexp_replace(uri, "^/|/$", ""), "/")


def page_type(uri: Column) -> Column:
    """First part of the path; cancel and return pages count as ``post_purchase``."""
    first = F.get(_uri_parts(uri), F.lit(0))
    return (
        F.when(first.isin("cancel", "return"), "post_purchase")
        .when(uri.isNull() | (uri == ""), "unknown")
        .otherwise(F.coalesce(first, F.lit("home")))
    )


def product_id(uri: Column) -> Column:
    """Number after ``/product/``; null for other pages and for text."""
    parts = _uri_parts(uri)
    return F.when(F.get(parts, F.lit(0)) == "product", F.get(parts, F.lit(1)).try_cast("bigint"))


def is_valid(click: str) -> Column:
    """True or false, never null: all required fields are there and the type is known."""
    present = F.col(click).isNotNull()
    for name in _REQUIRED:
        present = present & F.col(f"{click}.{name}").isNotNull()
    return present & F.col(f"{click}.event_type").isin(*EVENT_TYPES)


def is_json(text: str | Column) -> Column:
    """Whether the text parses as JSON at all."""
    return F.try_parse_json(text).isNotNull()
