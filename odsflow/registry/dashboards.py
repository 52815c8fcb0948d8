"""Dashboard charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from odsflow.plans import products, sales, trips
from odsflow.plans import dashboards as d
from odsflow.registry.base import add

# The dashboards are set to the whole time span of their data.
SALES = d.Range("1995-01-01", "2002-01-01")
CLICKS = d.Range("2024-01-01", "2024-02-01")
_SALES = "order_item_created_at >= DATE '1995-01-01' AND order_item_created_at < DATE '2002-01-01'"
_HOURS = "order_hour >= DATE '1995-01-01' AND order_hour < DATE '2002-01-01'"
_DAYS = "event_date >= DATE '2024-01-01' AND event_date < DATE '2024-02-01'"
_STARTS = "session_start >= DATE '2024-01-01' AND session_start < DATE '2024-02-01'"


def _flat(t, *columns: str):
    """The chart's columns of the flat sales mart, without the joins it does not need."""
    items = t.order_items("created_at", *columns)
    return items.withColumnsRenamed({"created_at": d.SALES_TIME, "status": "order_item_status"})


@add("dash_gross_revenue", f"SELECT CAST(SUM(sale_price) AS DOUBLE) AS gross_revenue FROM sales_flat WHERE {_SALES}")
def _(t):
    return d.gross_revenue(_flat(t, "sale_price"), SALES)


@add("dash_orders", f"SELECT COUNT(DISTINCT order_id) AS orders FROM sales_flat WHERE {_SALES}")
def _(t):
    return d.order_count(_flat(t, "order_id"), SALES)


@add("dash_net_profit", f"SELECT CAST(SUM(product_profit) AS DOUBLE) AS net_profit FROM sales_flat WHERE {_SALES}")
def _(t):
    profit = sales.sales_summary(
        SALES.on(t.order_items("created_at", "product_id", "sale_price"), "created_at"),
        t.products(),
        t.users("user_id", "country", "gender"),
        (),
        ("total_profit",),
    )
    return profit.withColumnRenamed("total_profit", "net_profit")


@add("dash_customers", f"SELECT COUNT(DISTINCT user_id) AS customers FROM sales_flat WHERE {_SALES}")
def _(t):
    return d.customer_count(_flat(t, "user_id"), SALES)


@add(
    "dash_aov",
    f"""SELECT CAST(SUM(sale_price) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0) AS aov
        FROM sales_flat WHERE {_SALES}""",
)
def _(t):
    return d.average_order_value(_flat(t, "order_id", "sale_price"), SALES)


@add(
    "dash_monthly_trend",
    f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(SUM(total_revenue) AS DOUBLE) AS revenue,
               CAST(SUM(total_profit) AS DOUBLE) AS profit
        FROM sales_hourly WHERE {_HOURS} GROUP BY 1""",
)
def _(t):
    return d.monthly_trend(t.order_items("created_at", "product_id", "sale_price"), t.products(), t.users(), SALES)


@add(
    "dash_status",
    f"""SELECT order_item_status, COUNT(*) AS items FROM sales_flat WHERE {_SALES}
        GROUP BY 1 ORDER BY items DESC, 1 LIMIT 20""",
)
def _(t):
    return d.items_by_status(_flat(t, "status"), SALES)


def _revenue_sql(keys: str, rows: int) -> str:
    return f"""SELECT {keys}, CAST(SUM(total_revenue) AS DOUBLE) AS revenue FROM sales_hourly WHERE {_HOURS}
               GROUP BY {keys} ORDER BY SUM(total_revenue) DESC, {keys} LIMIT {rows}"""


@add("dash_category", _revenue_sql("product_category", d.BAR_ROWS))
def _(t):
    items = t.order_items("created_at", "product_id", "sale_price")
    return d.revenue_by(items, t.products(), t.users(), SALES, ["product_category"])


@add("dash_country", _revenue_sql("user_country", d.BAR_ROWS))
def _(t):
    items = t.order_items("created_at", "user_id", "sale_price")
    return d.revenue_by(items, t.products(), t.users("user_id", "country", "gender"), SALES, ["user_country"])


@add(
    "dash_gender",
    f"""SELECT user_gender, CAST(SUM(sale_price) AS DOUBLE) AS revenue FROM sales_flat WHERE {_SALES}
        GROUP BY 1 ORDER BY SUM(sale_price) DESC, 1 LIMIT 20""",
)
def _(t):
    items = t.order_items("created_at", "user_id", "sale_price")
    return d.revenue_by(
        items, t.products(), t.users("user_id", "country", "gender"), SALES, ["user_gender"], d.PIE_ROWS
    )


@add(
    "dash_top_products",
    """SELECT product_name, product_category, product_brand, CAST(SUM(total_revenue) AS DOUBLE) AS revenue,
              CAST(SUM(net_items_sold) AS BIGINT) AS items_sold, round(AVG(return_rate), 6) AS return_rate
       FROM product_performance GROUP BY 1, 2, 3 ORDER BY SUM(total_revenue) DESC, 1, 2, 3 LIMIT 50""",
)
def _(t):
    items = t.order_items("id", "product_id", "status", "sale_price")
    performance = products.product_performance(t.products(), items, t.events())
    return d.top_products(performance).withColumn("return_rate", F.round("return_rate", 6))


@add("dash_department_category", _revenue_sql("product_department, product_category", d.TREE_ROWS))
def _(t):
    items = t.order_items("created_at", "product_id", "sale_price")
    keys = ["product_department", "product_category"]
    return d.revenue_by(items, t.products(), t.users(), SALES, keys, d.TREE_ROWS)


# -- clicks ------------------------------------------------------------------


@add("dash_sessions", f"SELECT COUNT(DISTINCT session_id) AS sessions FROM session_summary WHERE {_STARTS}")
def _(t):
    return d.session_figures(t.events(), CLICKS).select("sessions")


@add("dash_events", f"SELECT CAST(SUM(total_events) AS BIGINT) AS events FROM window_summary WHERE {_DAYS}")
def _(t):
    return d.event_count(t.events(), CLICKS)


@add("dash_purchases", f"SELECT CAST(SUM(purchase_count) AS BIGINT) AS purchases FROM session_summary WHERE {_STARTS}")
def _(t):
    return d.session_figures(t.events(), CLICKS).select("purchases")


@add(
    "dash_conversion",
    f"""SELECT ROUND(CAST(SUM(purchase_count) * 100 AS DOUBLE) / NULLIF(COUNT(DISTINCT session_id), 0), 2)
               AS conversion_pct FROM session_summary WHERE {_STARTS}""",
)
def _(t):
    return d.session_figures(t.events(), CLICKS).select("conversion_pct")


@add(
    "dash_event_types",
    f"""SELECT event_type, CAST(SUM(total_events) AS BIGINT) AS events FROM window_summary WHERE {_DAYS}
        GROUP BY event_type""",
)
def _(t):
    return d.events_by_type(t.events(), CLICKS)


def _sessions_sql(label: str, rows: int) -> str:
    return f"""SELECT {label}, COUNT(DISTINCT session_id) AS sessions FROM session_summary WHERE {_STARTS}
               GROUP BY {label} ORDER BY sessions DESC, {label} LIMIT {rows}"""


@add("dash_session_sources", _sessions_sql("traffic_source", d.PIE_ROWS))
def _(t):
    return d.sessions_by(t.events(), CLICKS, "traffic_source", d.PIE_ROWS)


@add("dash_browsers", _sessions_sql("browser", d.BAR_ROWS))
def _(t):
    return d.sessions_by(t.events(), CLICKS, "browser", d.BAR_ROWS)


@add(
    "dash_daily_events",
    f"""SELECT event_date, CAST(SUM(total_events) AS BIGINT) AS events FROM window_summary WHERE {_DAYS}
        GROUP BY event_date""",
)
def _(t):
    return d.events_by_day(t.events(), CLICKS)


@add(
    "dash_funnel_by_category",
    f"""SELECT top_category, COUNT(DISTINCT session_id) AS sessions,
               CAST(SUM(CASE WHEN saw_product THEN 1 ELSE 0 END) AS BIGINT) AS viewed_product,
               CAST(SUM(CASE WHEN added_to_cart THEN 1 ELSE 0 END) AS BIGINT) AS added_to_cart,
               CAST(SUM(CASE WHEN purchased THEN 1 ELSE 0 END) AS BIGINT) AS purchased
        FROM session_summary WHERE {_STARTS} GROUP BY top_category
        ORDER BY sessions DESC, top_category LIMIT 50""",
)
def _(t):
    return d.funnel_by_category(t.events(), t.products(), CLICKS)


@add(
    "dash_funnel_generic",
    """SELECT page_type, metric, CAST(metric AS DOUBLE) / MAX(metric) OVER () * 100 AS share_pct
       FROM (SELECT page_type, COUNT(*) AS metric FROM click_events GROUP BY page_type
             ORDER BY metric DESC, page_type LIMIT 20)""",
)
def _(t):
    return d.funnel_by(t.events(), ["page_type"], F.count(F.lit(1)))


# -- trips -------------------------------------------------------------------


@add(
    "trip_derived",
    """SELECT *  REPLACE (CAST(total_distance_km AS DOUBLE) AS total_distance_km), TRUE AS is_completed,
              trip_duration_minutes AS duration_minutes,
              CASE WHEN trip_duration_minutes > 0
                   THEN 60.0::DOUBLE * CAST(total_distance_km AS DOUBLE) / trip_duration_minutes ELSE 0.0 END AS avg_speed,
              hour((start_time AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Ho_Chi_Minh') AS hour_vn
       FROM trip_summary""",
)
def _(t):
    return trips.trip_columns(t.trips())


@add(
    "trip_kpis",
    """SELECT COUNT(trip_id) AS trips, COUNT(DISTINCT route_no) AS active_routes,
              COUNT(DISTINCT vehicle) AS active_vehicles, CAST(SUM(total_distance_km) AS DOUBLE) AS total_km,
              SUM(trip_duration_minutes) / COUNT(trip_duration_minutes) AS avg_minutes FROM trip_summary""",
)
def _(t):
    return trips.trip_figures(t.trips())


@add(
    "trip_kpis_chosen",
    """SELECT COUNT(trip_id) AS trips, COUNT(DISTINCT route_no) AS active_routes,
              COUNT(DISTINCT vehicle) AS active_vehicles, CAST(SUM(total_distance_km) AS DOUBLE) AS total_km,
              SUM(trip_duration_minutes) / COUNT(trip_duration_minutes) AS avg_minutes
       FROM trip_summary
       WHERE route_no IN ('3', '7', '11') AND date >= DATE '1996-01-01' AND date < DATE '1998-07-01'""",
)
def _(t):
    return trips.trip_figures(trips.choose(t.trips(), ["3", "7", "11"], "1996-01-01", "1998-07-01"))


@add("gps_avg_speed", "SELECT CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS avg_speed FROM gps_points WHERE speed > 0")
def _(t):
    return trips.average_speed(t.gps_points())


@add("trips_by_route", "SELECT route_no, COUNT(trip_id) AS trips FROM trip_summary GROUP BY route_no")
def _(t):
    return trips.trips_by(t.trips(), "route_no")


@add("trips_by_direction", "SELECT direction, COUNT(trip_id) AS trips FROM trip_summary GROUP BY direction")
def _(t):
    return trips.trips_by(t.trips(), "direction")


@add(
    "trips_by_hour",
    """SELECT hour((start_time AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Ho_Chi_Minh') AS hour_vn,
              COUNT(trip_id) AS trips FROM trip_summary GROUP BY 1""",
)
def _(t):
    return trips.trips_by(trips.trip_columns(t.trips()), "hour_vn")


_SPEED = "CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS avg_speed FROM gps_points WHERE speed > 0"


@add("speed_by_hour_daytype", f"SELECT hour AS hour_vn, day_type, {_SPEED} GROUP BY hour, day_type")
def _(t):
    return trips.speed_by(trips.point_columns(t.gps_points()), "hour_vn", "day_type")


@add("speed_levels", "SELECT speed_level, COUNT(*) AS points FROM gps_points GROUP BY speed_level")
def _(t):
    return trips.points_by_speed_level(t.gps_points())


@add("speed_by_route", f"SELECT route_no, {_SPEED} GROUP BY route_no")
def _(t):
    return trips.speed_by(t.gps_points(), "route_no")


@add(
    "gps_points",
    """SELECT y, x, speed_level, CAST(MAX(speed) AS DOUBLE) AS max_speed FROM gps_points
       WHERE x IS NOT NULL AND y IS NOT NULL AND speed IS NOT NULL
       GROUP BY y, x, speed_level ORDER BY max_speed DESC, y, x, speed_level LIMIT 15000""",
)
def _(t):
    return trips.map_points(t.gps_points())


_DETAIL = ", ".join(trips.TRIP_DETAIL)


@add(
    "trip_details",
    f"""SELECT * REPLACE (CAST(total_distance_km AS DOUBLE) AS total_distance_km)
        FROM (SELECT DISTINCT {_DETAIL} FROM trip_summary ORDER BY {_DETAIL} LIMIT 5000)""",
)
def _(t):
    return trips.trip_details(t.trips())
