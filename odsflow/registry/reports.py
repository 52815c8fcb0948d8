"""Analytical queries and ingest figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from odsflow.functions.times import latest
from odsflow.operators import clicks
from odsflow.operators.selection import recent_values, select_rows
from odsflow.plans import analytics, clickstream, monitoring, sales
from odsflow.registry.base import add
from odsflow.sinks import paths, refresh

_NOW = "(SELECT MAX(event_timestamp) FROM click_events)"

# -- recent activity ---------------------------------------------------------


@add(
    "q1_funnel",
    f"""
    WITH reached AS (
        SELECT count(*) AS started, count(*) FILTER (saw_product) AS saw, count(*) FILTER (added_to_cart) AS added,
               count(*) FILTER (purchased) AS bought
        FROM session_summary WHERE session_start >= {_NOW} - to_hours(1))
    SELECT started AS total_sessions, CASE WHEN started > 0 THEN saw END AS viewed_product_sessions,
           CASE WHEN started > 0 THEN added END AS add_to_cart_sessions,
           CASE WHEN started > 0 THEN bought END AS purchase_sessions,
           CASE WHEN started > 0 THEN saw::DOUBLE / started * 100 END AS view_rate_pct,
           CASE WHEN saw > 0 THEN added::DOUBLE / saw * 100 END AS cart_add_rate_pct,
           CASE WHEN added > 0 THEN bought::DOUBLE / added * 100 END AS purchase_rate_pct
    FROM reached""",
)
def _(t):
    events = t.events()
    return analytics.recent_funnel(events, latest(events, "event_timestamp"))


@add(
    "q2_freshness",
    """
    SELECT COUNT(event_id) AS events_ingested, CAST(COUNT(event_id) AS DOUBLE) / 300.0::DOUBLE AS avg_throughput_eps,
           CAST(SUM(event_lag_seconds) AS DOUBLE) / NULLIF(COUNT(event_lag_seconds), 0) AS avg_latency_seconds,
           CAST(MIN(event_lag_seconds) AS DOUBLE) AS min_latency_seconds,
           CAST(MAX(event_lag_seconds) AS DOUBLE) AS max_latency_seconds
    FROM click_events WHERE ingested_at >= (SELECT MAX(ingested_at) FROM click_events) - INTERVAL 5 MINUTE""",
)
def _(t):
    return analytics.freshness(t.events())


@add(
    "q3_trending",
    f"""
    WITH shown AS (
        SELECT product_id, session_id, count(event_id) AS views FROM click_events
        WHERE event_type = 'product' AND event_timestamp >= {_NOW} - to_minutes(15) GROUP BY ALL)
    SELECT category AS product_category, brand AS product_brand, name AS product_name,
           sum(views)::BIGINT AS total_views, count(DISTINCT session_id) AS unique_view_sessions
    FROM shown JOIN dim_products USING (product_id)
    GROUP BY ALL ORDER BY total_views DESC, product_category, product_brand, product_name LIMIT 10""",
)
def _(t):
    return analytics.trending(t.events(), t.products())


_MARGIN = """CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit,
    returned_items, CAST(total_profit AS DOUBLE) / NULLIF(CAST(total_revenue AS DOUBLE), 0) * 100 AS profit_margin_percent"""
_SALES_ITEMS = ("id", "order_id", "user_id", "product_id", "status", "created_at", "sale_price")


@add(
    "q4_hourly_rows",
    f"""
    SELECT order_hour, total_orders, {_MARGIN} FROM sales_hourly
    ORDER BY order_hour DESC, product_category, product_department, user_country, user_gender LIMIT 24""",
)
def _(t):
    # 24 rows come from no more than 24 hours.
    items = sales.since_newest_hours(t.order_items(*_SALES_ITEMS), 24)
    hourly = sales.sales_summary(items, t.products(), t.users("user_id", "country", "gender"))
    return analytics.latest_hourly_rows(hourly)


@add(
    "q4b_hourly_rollup",
    f"""
    SELECT order_hour, total_orders, {_MARGIN} FROM (
        SELECT date_trunc('hour', oi.created_at) AS order_hour, COUNT(DISTINCT oi.order_id) AS total_orders,
               SUM(oi.sale_price) AS total_revenue, SUM(oi.sale_price - p.cost) AS total_profit,
               CAST(SUM(CASE WHEN oi.status = 'Returned' THEN 1 ELSE 0 END) AS BIGINT) AS returned_items
        FROM fact_order_items oi LEFT JOIN dim_products p ON oi.product_id = p.product_id GROUP BY 1)
    ORDER BY order_hour DESC LIMIT 24""",
)
def _(t):
    return analytics.latest_hours(t.order_items(*_SALES_ITEMS), t.products(), t.users("user_id", "country", "gender"))


# -- click reports -----------------------------------------------------------


@add("cs1_totals", "SELECT COUNT(*) AS total_events, COUNT(DISTINCT session_id) AS unique_sessions FROM click_events")
def _(t):
    return analytics.click_totals(t.events())


@add(
    "cs2_by_event_type",
    """SELECT event_type, COUNT(event_id) AS event_count, COUNT(DISTINCT session_id) AS unique_sessions
       FROM click_events GROUP BY event_type""",
)
def _(t):
    return analytics.clicks_by_type(t.events())


@add(
    "cs3_sources",
    """SELECT traffic_source, COUNT(DISTINCT session_id) AS sessions,
              CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases
       FROM click_events GROUP BY traffic_source ORDER BY purchases DESC, traffic_source LIMIT 10""",
)
def _(t):
    return analytics.top_sources(t.events())


@add(
    "cs4_window_read",
    """SELECT window_start, window_end, traffic_source, total_events, unique_sessions FROM window_summary
       ORDER BY window_start, traffic_source, browser, event_type, page_type LIMIT 50""",
)
def _(t):
    return analytics.first_windows(t.events())


@add(
    "cs5_session_read",
    """SELECT session_id, session_duration_seconds, event_count, purchased, top_category
       FROM session_summary ORDER BY session_id LIMIT 50""",
)
def _(t):
    return analytics.first_sessions(t.events(), t.products())


# -- order reports -----------------------------------------------------------


@add("cdc1_orders_by_status", "SELECT status, COUNT(*) AS order_count FROM fact_orders GROUP BY status")
def _(t):
    return analytics.orders_by_status(t.orders("status"))


@add(
    "cdc2_revenue_by_category",
    """SELECT p.category, COUNT(oi.id) AS items_sold, CAST(SUM(oi.sale_price) AS DOUBLE) AS total_revenue
       FROM fact_order_items oi JOIN dim_products p ON oi.product_id = p.product_id
       GROUP BY p.category ORDER BY SUM(oi.sale_price) DESC, p.category LIMIT 10""",
)
def _(t):
    return analytics.revenue_by_category(t.order_items("id", "product_id", "sale_price"), t.products())


@add(
    "cdc3_demographics",
    """SELECT country, gender, COUNT(*) AS user_count FROM dim_users GROUP BY country, gender
       ORDER BY user_count DESC, country, gender LIMIT 20""",
)
def _(t):
    return analytics.demographics(t.users("country", "gender"))


@add(
    "cdc4_orders_by_demographic",
    """SELECT u.country, u.gender, COUNT(o.order_id) AS total_orders,
              CAST(SUM(o.num_of_item) AS DOUBLE) / COUNT(o.num_of_item) AS avg_items_per_order
       FROM fact_orders o JOIN dim_users u ON o.user_id = u.user_id
       GROUP BY u.country, u.gender ORDER BY total_orders DESC, u.country, u.gender LIMIT 15""",
)
def _(t):
    return analytics.orders_by_demographic(
        t.orders("order_id", "user_id", "num_of_item"), t.users("user_id", "country", "gender")
    )


@add(
    "cdc5_stock_by_centre",
    """SELECT dc.name AS distribution_center, COUNT(i.id) AS stock_items
       FROM fact_inventory_items i JOIN dim_products p ON i.product_id = p.product_id
       JOIN dim_centres dc ON p.distribution_center_id = dc.id WHERE i.sold_at IS NULL GROUP BY dc.name""",
)
def _(t):
    return analytics.stock_by_centre(
        t.inventory_items("id", "product_id", "sold_at"), t.products(), t.centres()
    )


# -- ingest figures ----------------------------------------------------------


#: Lags that count, as hours of events.
_LAGS = """(SELECT date_trunc('hour', event_timestamp) AS hour, event_lag_seconds AS lag FROM click_events
            WHERE event_lag_seconds >= 0 AND event_lag_seconds < 3600)"""


def _stored_lag(t):
    folder = paths.scratch(t.spark, "lag-hours")
    refresh.refresh(analytics.lag_hours(t.events()), folder)
    return refresh.read_current(t.spark, folder)


@add(
    "lag_daily_sketch",
    f"""
    SELECT date_trunc('day', hour)::TIMESTAMP AS period, count(*) AS sample_size, sum(lag)::DOUBLE / count(*) AS avg_lag,
           max(lag)::DOUBLE AS max_lag, true AS p50_holds, true AS p95_holds, true AS p99_holds
    FROM {_LAGS} GROUP BY 1""",
)
def _(t):
    # The estimates differ from run to run; that their ranks hold is what can be compared.
    summary = analytics.lag_summary(_stored_lag(t))
    off = analytics.rank_errors(summary, t.events()).withColumnRenamed("period", "of")
    holds = [(F.col(f"p{p}_off") <= analytics.RANK_ERROR).alias(f"p{p}_holds") for p in analytics.LAG_QUANTILES]
    joined = summary.join(off, F.col("period").eqNullSafe(F.col("of")))
    return joined.select("period", "sample_size", "avg_lag", "max_lag", *holds)


@add(
    "lag_newest_hours",
    f"""
    WITH hours AS (SELECT hour, count(*) AS n FROM {_LAGS} GROUP BY 1),
    newest AS (SELECT hour FROM hours QUALIFY coalesce(sum(n) OVER (ORDER BY hour DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 5000)
    SELECT count(*) AS sample_size, sum(lag)::DOUBLE / count(*) AS avg_lag, max(lag)::DOUBLE AS max_lag
    FROM {_LAGS} JOIN newest USING (hour)""",
)
def _(t):
    return analytics.newest_lag(_stored_lag(t)).select("sample_size", "avg_lag", "max_lag")


@add(
    "lag_recent_stats",
    """
    SELECT COUNT(*) AS sample_size, CAST(SUM(lag) AS DOUBLE) / COUNT(*) AS avg_lag,
           round(quantile_cont(CAST(lag AS DOUBLE), 0.5), 6) AS p50_lag,
           round(quantile_cont(CAST(lag AS DOUBLE), 0.95), 6) AS p95_lag,
           round(quantile_cont(CAST(lag AS DOUBLE), 0.99), 6) AS p99_lag, CAST(MAX(lag) AS DOUBLE) AS max_lag
    FROM (SELECT event_lag_seconds AS lag FROM click_events
          WHERE event_lag_seconds IS NOT NULL AND event_lag_seconds >= 0 AND event_lag_seconds < 3600
          ORDER BY event_timestamp DESC, event_id DESC LIMIT 5000)""",
)
def _(t):
    rounded = {f"p{p}_lag": F.round(f"p{p}_lag", 6) for p in (50, 95, 99)}
    return analytics.recent_lag(t.events()).withColumns(rounded)


@add(
    "throughput_stability",
    """
    SELECT COUNT(*) AS samples, round(AVG(rate), 6) AS mean_rate, round(stddev_samp(rate), 6) AS stdev_rate,
           AVG(rate) = 0 OR stddev_samp(rate) / AVG(rate) < 0.2 AS is_stable
    FROM (SELECT CAST(COUNT(*) AS DOUBLE) / 3600 AS rate FROM click_events
          GROUP BY time_bucket(INTERVAL '1 hour', event_timestamp))""",
)
def _(t):
    return analytics.throughput(t.events()).withColumns(
        {"mean_rate": F.round("mean_rate", 6), "stdev_rate": F.round("stdev_rate", 6)}
    )


_COUNTED = {
    "dwd_clickstream_events": "click_events",
    "dim_distribution_centers": "dim_centres",
    "dim_products": "dim_products",
    "dim_users": "dim_users",
    "fact_inventory_items": "fact_inventory_items",
    "fact_orders": "fact_orders",
    "fact_order_items": "fact_order_items",
}


@add(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {table}" for name, table in _COUNTED.items()
    ),
)
def _(t):
    return analytics.table_counts(
        {
            "dwd_clickstream_events": t.events(),
            "dim_distribution_centers": t.centres(),
            "dim_products": t.products(),
            "dim_users": t.users("user_id"),
            "fact_inventory_items": t.inventory_items("id"),
            "fact_orders": t.orders("order_id"),
            "fact_order_items": t.order_items("id"),
        }
    )


@add("mon_events_1h", f"SELECT COUNT(*) AS value FROM click_events WHERE event_timestamp >= {_NOW} - INTERVAL 1 HOUR")
def _(t):
    return monitoring.events_last_hour(t.events())


@add(
    "mon_lag_5m",
    f"""SELECT COALESCE(CAST(SUM(event_lag_seconds) AS DOUBLE) / NULLIF(COUNT(event_lag_seconds), 0), 0) AS value
        FROM click_events WHERE event_timestamp >= {_NOW} - INTERVAL 5 MINUTE""",
)
def _(t):
    return monitoring.lag_last_minutes(t.events())


@add("mon_deadletters", "SELECT COUNT(*) AS value FROM click_messages WHERE verdict NOT IN ('valid', 'none')")
def _(t):
    return monitoring.dead_letter_count(clicks.dead_letters(clicks.parse(t.click_topic())))


@add(
    "mon_per_minute",
    f"""SELECT date_trunc('minute', event_timestamp) AS time, COUNT(*) AS value FROM click_events
        WHERE event_timestamp >= {_NOW} - INTERVAL 1 HOUR GROUP BY 1""",
)
def _(t):
    return monitoring.events_per_minute(t.events())


@add("mon_event_types", "SELECT event_type AS metric, COUNT(*) AS value FROM click_events GROUP BY event_type")
def _(t):
    return monitoring.events_by_type(t.events())


@add(
    "mon_topic_rate",
    """SELECT 'clickstream-events' AS topic, date_trunc('minute', ts) AS minute,
              CAST(COUNT(*) AS DOUBLE) / 60.0::DOUBLE AS per_second
       FROM events GROUP BY date_trunc('minute', ts)""",
)
def _(t):
    return monitoring.topic_rate(t.click_topic())


# -- reading a table ---------------------------------------------------------


@add(
    "table_select",
    """SELECT order_id, user_id, status, created_at FROM fact_orders WHERE status = 'Processing'
       ORDER BY created_at DESC, order_id LIMIT 20""",
)
def _(t):
    columns = ["order_id", "user_id", "status", "created_at"]
    return select_rows(
        t.orders(*columns), columns, "status = 'Processing'", [F.desc("created_at"), "order_id"], 20
    )


@add(
    "filter_values_30d",
    """SELECT DISTINCT status FROM fact_orders
       WHERE created_at >= (SELECT MAX(created_at) FROM fact_orders) - INTERVAL 30 DAY""",
)
def _(t):
    return recent_values(t.orders("status", "created_at"), "status", "created_at")
