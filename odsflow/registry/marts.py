"""Marts and the parts they are made of."""

from __future__ import annotations

from odsflow.plans import clickstream, inventory, products, sales
from odsflow.registry.base import add
from odsflow.sinks import paths, refresh

_WINDOW = """aggregate_id, window_start, window_end, event_date, traffic_source, browser, event_type, page_type,
    total_events, unique_sessions, unique_users, purchase_events, avg_event_lag_seconds"""


@add("window_agg", f"SELECT {_WINDOW} FROM window_summary")
def _(t):
    return clickstream.window_summary(t.events()).drop("version_emitted_at")


@add("session_events", "SELECT * FROM session_events")
def _(t):
    return clickstream.session_events(t.events(), t.products())


@add("session_base", "SELECT * FROM session_base")
def _(t):
    return clickstream.session_base(t.events())


@add("session_categories", "SELECT * FROM session_categories")
def _(t):
    return clickstream.session_categories(t.events(), t.products())


@add("session_top_category", "SELECT * FROM session_top")
def _(t):
    return clickstream.session_top_category(t.events(), t.products())


@add("sessions", "SELECT * FROM session_summary")
def _(t):
    return clickstream.sessions(t.events(), t.products())


_MONEY = ("sale_price", "product_cost", "product_retail_price", "product_profit")


def _doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


_FLAT_ITEMS = (
    "id", "order_id", "product_id", "inventory_item_id", "status", "shipped_at", "delivered_at", "returned_at",
    "sale_price",
)


@add("sales_flat", f"SELECT * REPLACE ({_doubles(*_MONEY)}) FROM sales_flat")
def _(t):
    orders = t.orders("order_id", "user_id", "created_at", "status", "num_of_item")
    return sales.sales_flat(t.order_items(*_FLAT_ITEMS), t.products(), t.users(), t.centres(), orders)


_HOURLY_MONEY = ("total_revenue", "total_cost", "total_profit", "net_revenue", "net_profit")
_HOURLY_ITEMS = ("id", "order_id", "user_id", "product_id", "status", "created_at", "sale_price")


@add("sales_hourly", f"SELECT * REPLACE ({_doubles(*_HOURLY_MONEY)}) FROM sales_hourly")
def _(t):
    items = t.order_items("id", "order_id", "product_id", "status", "sale_price")
    orders = t.orders("order_id", "user_id", "created_at")
    return sales.sales_summary(items, t.products(), t.users("user_id", "country", "gender"), orders=orders)


def _rolled(t, period):
    """Stored hours and their roll-up."""
    folder = paths.scratch(t.spark, "sales-hours")
    items = t.order_items(*_HOURLY_ITEMS)
    refresh.refresh(sales.hourly_sums(items, t.products(), t.users("user_id", "country", "gender")), f"{folder}/sums")
    refresh.refresh(sales.hourly_ids(t.order_items("order_id", "user_id", "created_at")), f"{folder}/ids")
    stored = [refresh.read_current(t.spark, f"{folder}/{name}") for name in ("sums", "ids")]
    return sales.roll_up(*stored, period)


def _rolled_sql(period: str) -> str:
    unit = f"date_trunc('{period}', created_at)::TIMESTAMP"
    kept = "status NOT IN ('Cancelled', 'Returned')"
    return f"""
    SELECT {unit} AS period, count(id) AS total_items_ordered, sum(sale_price)::DOUBLE AS total_revenue,
           sum(cost)::DOUBLE AS total_cost, sum(sale_price - cost)::DOUBLE AS total_profit,
           count(*) FILTER (status = 'Returned') AS returned_items, count(*) FILTER (status = 'Cancelled') AS cancelled_items,
           sum(CASE WHEN {kept} THEN sale_price ELSE 0 END)::DOUBLE AS net_revenue,
           sum(CASE WHEN {kept} THEN sale_price - cost ELSE 0 END)::DOUBLE AS net_profit,
           count(DISTINCT order_id) AS total_orders, count(DISTINCT user_id) AS total_customers
    FROM fact_order_items LEFT JOIN (SELECT product_id, cost FROM dim_products) USING (product_id) GROUP BY 1"""


@add("sales_daily_rollup", _rolled_sql("day"))
def _(t):
    return _rolled(t, "day")


@add("sales_monthly_rollup", _rolled_sql("month"))
def _(t):
    return _rolled(t, "month")


_SALES_ITEMS = ("id", "product_id", "status", "sale_price")


@add("product_sales", f"SELECT * REPLACE ({_doubles('total_revenue', 'net_revenue')}) FROM product_sales")
def _(t):
    return products.product_sales(t.order_items(*_SALES_ITEMS))


@add("product_views", "SELECT * FROM product_views")
def _(t):
    return products.product_views(t.events())


_PERFORMANCE_MONEY = (
    "retail_price", "cost", "unit_profit", "total_revenue", "net_revenue", "total_cost", "total_profit",
)


@add("product_performance", f"SELECT * REPLACE ({_doubles(*_PERFORMANCE_MONEY)}) FROM product_performance")
def _(t):
    return products.product_performance(t.products(), t.order_items(*_SALES_ITEMS), t.events())


@add(
    "inventory_details",
    """
    WITH stock AS (
        SELECT id AS inventory_item_id, product_id, created_at AS inventory_created_at, sold_at AS inventory_sold_at,
               cost::DOUBLE AS cost, product_retail_price::DOUBLE AS retail_price, product_category, product_name,
               product_brand, product_department, product_sku, product_distribution_center_id AS centre,
               (epoch_us(sold_at) - epoch_us(created_at)) // 86400000000 AS days_to_sell
        FROM fact_inventory_items)
    SELECT * EXCLUDE (centre, id), inventory_created_at::DATE AS inventory_created_date,
           inventory_sold_at::DATE AS inventory_sold_date, (inventory_sold_at IS NULL)::BIGINT AS is_stock_on_hand,
           (inventory_sold_at IS NOT NULL)::BIGINT AS is_sold
    FROM stock LEFT JOIN (SELECT id, name AS distribution_center_name FROM dim_centres) ON centre = id""",
)
def _(t):
    return inventory.inventory_details(t.inventory_items(), t.centres())
