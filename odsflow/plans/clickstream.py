"""Click summaries: five-minute windows and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odsflow.functions.measures import any_where, count_where, mean
from odsflow.functions.times import whole_units_between
from odsflow.operators.joins import fits_broadcast, lookup_join
from odsflow.schemas import PAGEVIEW_TYPES

WINDOW_LENGTH, WINDOW_SECONDS = "5 minutes", 300


def window_number(time: Column) -> Column:
    """Number of the window that a time is in, counted from 1970; in the order of the windows."""
    return F.floor(F.unix_timestamp(time.cast("timestamp")) / WINDOW_SECONDS)


def window_summary(events: DataFrame) -> DataFrame:
    """Counts per five-minute window, source, browser, event type and page type."""
    labels = ("traffic_source", "browser", "event_type", "page_type")
    grouped = events.groupBy(
        F.window("event_timestamp", WINDOW_LENGTH).alias("w"),
        F.col("event_timestamp").cast("date").alias("event_date"),
        *labels,
    ).agg(
        F.count("event_id").alias("total_events"),
        F.countDistinct("session_id").alias("unique_sessions"),
        F.countDistinct("user_id").alias("unique_users"),
        count_where(F.col("event_type") == "purchase").alias("purchase_events"),
        mean("event_lag_seconds").alias("avg_event_lag_seconds"),
    )
    name = [F.date_format("w.start", "yyyy-MM-dd HH:mm:ss")]
    name += [F.coalesce(F.col(label), F.lit("unknown")) for label in labels]
    return grouped.select(
        F.concat_ws("_", *name).alias("aggregate_id"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "event_date",
        *labels,
        "total_events",
        "unique_sessions",
        "unique_users",
        "purchase_events",
        "avg_event_lag_seconds",
        F.current_timestamp().alias("version_emitted_at"),
    )


def session_events(events: DataFrame, products: DataFrame) -> DataFrame:
    """Events with the category of the product they show, where there is one."""
    categories = products.select("product_id", F.col("category").alias("product_category"))
    return lookup_join(events, categories, "product_id").select(
        "event_id",
        "session_id",
        "user_id",
        "traffic_source",
        "browser",
        "event_timestamp",
        "event_type",
        "page_type",
        "product_id",
        "product_category",
    )


def _session_measures() -> dict[str, Column]:
    page, event = F.col("page_type"), F.col("event_type")
    return {
        "session_start": F.min("event_timestamp"),
        "session_end": F.max("event_timestamp"),
        "event_count": F.count(F.lit(1)),
        "pageview_count": count_where(page.isin(*PAGEVIEW_TYPES)),
        "product_view_count": count_where(page == "product"),
        "cart_count": count_where(event == "cart"),
        "purchase_count": count_where(event == "purchase"),
        "saw_home": any_where(page == "home"),
        "saw_product": any_where(page == "product"),
        "added_to_cart": any_where(event == "cart"),
        "purchased": any_where(event == "purchase"),
    }


#: How partial measures of one session are put together.
_MERGE = {
    "session_start": F.min,
    "session_end": F.max,
    **dict.fromkeys(
        ("event_count", "pageview_count", "product_view_count", "cart_count", "purchase_count"), F.sum
    ),
    **dict.fromkeys(("saw_home", "saw_product", "added_to_cart", "purchased"), F.bool_or),
}
_LABELS = ("user_id", "traffic_source", "browser")


def _duration() -> Column:
    return whole_units_between("SECOND", "session_start", "session_end")


def events_of_sessions_since(events: DataFrame, start: Column) -> DataFrame:
    """All events of the sessions whose first event is at ``start`` or later.

    Such sessions have no event before it. Older events are read for their session alone, and only
    those meet the others whose session is active since.
    """
    since = events.where(F.col("event_timestamp") >= start)
    active = since.select("session_id").distinct()
    older = events.where(F.col("event_timestamp") < start).select(F.col("session_id").alias("of"))
    same = F.col("session_id").eqNullSafe(F.col("of"))
    begun = active.join(older, same, "left_semi").select(F.col("session_id").alias("of"))
    return since.join(begun, same, "left_anti")


def session_base(events: DataFrame) -> DataFrame:
    """One row per session: who, when, how much, and which steps were reached.

    The labels are grouping keys first, so that raw events are hashed; a minimum over text would
    sort them. Only the few rows per session that are left meet the minimum.
    """
    merged = [merge(name).alias(name) for name, merge in _MERGE.items()]
    return (
        events.groupBy("session_id", *_LABELS)
        .agg(*[measure.alias(name) for name, measure in _session_measures().items()])
        .groupBy("session_id")
        .agg(*[F.min(label).alias(label) for label in _LABELS], *merged)
        .withColumn("session_duration_seconds", _duration())
    )


def session_categories(events: DataFrame, products: DataFrame) -> DataFrame:
    """How often each session met each product category."""
    return (
        _by_category(events, products, "session_id")
        .where(F.col("product_category").isNotNull())
        .select("session_id", "product_category", F.col("event_count").alias("cnt"))
    )


def session_top_category(events: DataFrame, products: DataFrame) -> DataFrame:
    """The category met most often in each session; ties go to the first name."""
    return (
        session_categories(events, products)
        .groupBy("session_id")
        .agg(_top_category(F.col("cnt")).alias("top_category"))
    )


def sessions(events: DataFrame, products: DataFrame) -> DataFrame:
    """Session summary with the top category.

    Totals and category counts come from one partial aggregate, so events are read once
    and nothing is joined back. The labels are grouping keys in it, because a minimum over
    text would rule out hash aggregation on the large input. What is left, a few rows per
    session, is shuffled once by session for the two remaining steps.
    """
    merged = [merge(name).alias(name) for name, merge in _MERGE.items()]
    labels = [F.min(label).alias(label) for label in _LABELS]
    return (
        _by_category(events, products, "session_id", *_LABELS)
        .repartition("session_id")
        .groupBy("session_id", "product_category")
        .agg(*labels, *merged)
        .groupBy("session_id")
        .agg(*labels, *merged, _top_category(F.col("event_count")).alias("top_category"))
        .select(
            F.col("session_id").alias("session_record_id"),
            "session_id",
            *_LABELS,
            "session_start",
            "session_end",
            _duration().alias("session_duration_seconds"),
            *[name for name in _MERGE if name not in ("session_start", "session_end")],
            "top_category",
            F.col("session_start").cast("date").alias("session_date"),
        )
    )


def _by_category(events: DataFrame, products: DataFrame, *keys: str) -> DataFrame:
    """Session measures per ``keys`` and product category.

    With a catalogue too large to broadcast, events are first brought down to one row per
    ``keys`` and product, so that a hot session or product is already small when the join
    shuffles it.
    """
    categories = products.select("product_id", F.col("category").alias("product_category"))
    measures = _session_measures()
    if not fits_broadcast(categories):
        events = events.groupBy(*keys, "product_id").agg(*[m.alias(n) for n, m in measures.items()])
        measures = {name: merge(name) for name, merge in _MERGE.items()}
    return (
        lookup_join(events, categories, "product_id")
        .groupBy(*keys, "product_category")
        .agg(*[m.alias(n) for n, m in measures.items()])
    )


def _top_category(count: Column) -> Column:
    # Smallest of (-count, name): the highest count, and the first name on ties.
    category = F.col("product_category")
    return F.min(F.when(category.isNotNull(), F.struct((-count).alias("n"), category.alias("c"))))["c"]
