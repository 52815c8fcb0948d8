"""Sales and click dashboards: one aggregate over a mart per chart.

Additive measures of a mart are computed straight from its detail table: the sum over a
summary equals the sum over its rows, without grouping twice. Where the mart is stored, charts
take it as ``mart`` instead; its date column bounds what is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odsflow.functions.measures import count_where, ratio
from odsflow.functions.times import Moment, as_moment, in_range
from odsflow.plans.clickstream import session_base, sessions
from odsflow.plans.sales import sales_summary

# Row limits of the charts.
PIE_ROWS, TABLE_ROWS, BAR_ROWS, TREE_ROWS, FUNNEL_ROWS = 20, 50, 5000, 1000, 20


@dataclass(frozen=True)
class Range:
    """Half-open time range; a missing bound is open. Sales bounds are whole hours."""

    start: Moment | None = None
    end: Moment | None = None

    def on(self, df: DataFrame, column: str) -> DataFrame:
        return in_range(df, column, self.start, self.end)


def top_groups(df: DataFrame, keys: list[str], metric: str, rows: int) -> DataFrame:
    """Largest ``rows`` groups by ``metric``; equal ones in key order."""
    return df.orderBy(F.desc(metric), *[F.col(k).asc_nulls_last() for k in keys]).limit(rows)


# -- sales -------------------------------------------------------------------
# ``sales`` has the columns of the flat sales mart that the chart uses.

SALES_TIME = "order_item_created_at"


def sales_figure(sales: DataFrame, within: Range, name: str, metric: Column) -> DataFrame:
    return within.on(sales, SALES_TIME).agg(metric.alias(name))


def gross_revenue(sales: DataFrame, within: Range) -> DataFrame:
    return sales_figure(sales, within, "gross_revenue", F.sum("sale_price"))


def order_count(sales: DataFrame, within: Range) -> DataFrame:
    return sales_figure(sales, within, "orders", F.countDistinct("order_id"))


def net_profit(sales: DataFrame, within: Range) -> DataFrame:
    return sales_figure(sales, within, "net_profit", F.sum("product_profit"))


def customer_count(sales: DataFrame, within: Range) -> DataFrame:
    return sales_figure(sales, within, "customers", F.countDistinct("user_id"))


def average_order_value(sales: DataFrame, within: Range) -> DataFrame:
    return sales_figure(sales, within, "aov", ratio(F.sum("sale_price"), F.countDistinct("order_id")))


def items_by_status(sales: DataFrame, within: Range) -> DataFrame:
    counted = (
        within.on(sales, SALES_TIME).groupBy("order_item_status").agg(F.count(F.lit(1)).alias("items"))
    )
    return top_groups(counted, ["order_item_status"], "items", PIE_ROWS)


def revenue_by_gender(sales: DataFrame, within: Range) -> DataFrame:
    summed = within.on(sales, SALES_TIME).groupBy("user_gender").agg(F.sum("sale_price").alias("revenue"))
    return top_groups(summed, ["user_gender"], "revenue", PIE_ROWS)


def _stored(mart: DataFrame, within: Range, time: str, date: str) -> DataFrame:
    """Rows of a stored mart in a range of its times, with the same range of days for its partitions."""
    days = Range(
        None if within.start is None else as_moment(within.start).cast("date"),
        None if within.end is None else F.date_add(as_moment(within.end).cast("date"), 1),
    )
    return days.on(within.on(mart, time), date)


def monthly_trend(
    items: DataFrame | None,
    products: DataFrame | None,
    users: DataFrame | None,
    within: Range,
    mart: DataFrame | None = None,
) -> DataFrame:
    """Revenue and profit by month, from items or from the stored hourly sales."""
    if mart is not None:
        daily = _stored(mart, within, "order_hour", "order_date")
    else:
        daily = sales_summary(
            within.on(items, "created_at"), products, users, ("order_date",), ("total_revenue", "total_profit")
        )
    return (
        daily.groupBy(F.trunc("order_date", "month").alias("month"))
        .agg(F.sum("total_revenue").alias("revenue"), F.sum("total_profit").alias("profit"))
        .orderBy("month")
    )


def revenue_by(
    items: DataFrame | None,
    products: DataFrame | None,
    users: DataFrame | None,
    within: Range,
    keys: list[str],
    rows: int = BAR_ROWS,
    mart: DataFrame | None = None,
) -> DataFrame:
    """Revenue by product category, department, user country, or several of them, from items or from
    the stored hourly sales."""
    if mart is not None:
        hours = _stored(mart, within, "order_hour", "order_date")
        summed = hours.groupBy(*keys).agg(F.sum("total_revenue").alias("revenue"))
    else:
        summed = sales_summary(
            within.on(items, "created_at"), products, users, tuple(keys), ("total_revenue",)
        ).withColumnRenamed("total_revenue", "revenue")
    return top_groups(summed, keys, "revenue", rows)


def top_products(performance: DataFrame, rows: int = TABLE_ROWS) -> DataFrame:
    keys = ["product_name", "product_category", "product_brand"]
    grouped = performance.groupBy(*keys).agg(
        F.sum("total_revenue").alias("revenue"),
        F.sum("net_items_sold").alias("items_sold"),
        F.avg("return_rate").alias("return_rate"),
    )
    return top_groups(grouped, keys, "revenue", rows)


# -- clicks ------------------------------------------------------------------


def _started(events: DataFrame | None, within: Range, mart: DataFrame | None) -> DataFrame:
    """Sessions that started in the range, from events or from the stored sessions."""
    if mart is not None:
        return _stored(mart, within, "session_start", "session_date")
    return within.on(session_base(events), "session_start")


def session_figures(events: DataFrame | None, within: Range, mart: DataFrame | None = None) -> DataFrame:
    """Sessions, purchases and purchases per hundred sessions.

    After the grouping there is one row per session, so counting rows counts sessions.
    """
    started = _started(events, within, mart)
    bought, count = F.sum("purchase_count"), F.count("session_id")
    return started.agg(
        count.alias("sessions"),
        bought.alias("purchases"),
        F.round(ratio(bought * F.lit(100), count), 2).alias("conversion_pct"),
    )


def event_count(events: DataFrame, within: Range) -> DataFrame:
    return within.on(events, "event_date").agg(F.count("event_id").alias("events"))


def events_by_type(events: DataFrame, within: Range) -> DataFrame:
    counted = within.on(events, "event_date").groupBy("event_type").agg(F.count("event_id").alias("events"))
    return top_groups(counted, ["event_type"], "events", BAR_ROWS)


def events_by_day(events: DataFrame, within: Range) -> DataFrame:
    return (
        within.on(events, "event_date")
        .groupBy("event_date")
        .agg(F.count("event_id").alias("events"))
        .orderBy("event_date")
    )


def sessions_by(
    events: DataFrame | None, within: Range, label: str, rows: int, mart: DataFrame | None = None
) -> DataFrame:
    """Sessions by traffic source or browser."""
    counted = (
        _started(events, within, mart)
        .groupBy(label)
        .agg(F.count("session_id").alias("sessions"))
    )
    return top_groups(counted, [label], "sessions", rows)


def funnel_by_category(
    events: DataFrame | None, products: DataFrame | None, within: Range, mart: DataFrame | None = None
) -> DataFrame:
    started = within.on(sessions(events, products), "session_start") if mart is None else _started(None, within, mart)
    counted = (
        started.groupBy("top_category")
        .agg(
            F.count("session_id").alias("sessions"),
            count_where(F.col("saw_product")).alias("viewed_product"),
            count_where(F.col("added_to_cart")).alias("added_to_cart"),
            count_where(F.col("purchased")).alias("purchased"),
        )
    )
    return top_groups(counted, ["top_category"], "sessions", TABLE_ROWS)


def funnel_by(df: DataFrame, keys: list[str], metric: Column, rows: int = FUNNEL_ROWS) -> DataFrame:
    """Any metric by any dimension, largest first, each as a share of the largest."""
    steps = top_groups(df.groupBy(*keys).agg(metric.alias("metric")), keys, "metric", rows)
    # At most ``rows`` rows are left, so a window over all of them is small.
    largest = F.max("metric").over(Window.partitionBy())
    return steps.withColumn("share_pct", ratio(F.col("metric"), largest) * F.lit(100))
