"""Tables and marts as temporary views, for use from SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from odsflow.plans import clickstream, inventory, products, sales
from odsflow.sinks.refresh import read_current, refresh

TABLES = (
    "dwd_clickstream_events",
    "ods_clickstream_deadletter",
    "dim_users",
    "dim_products",
    "dim_distribution_centers",
    "fact_orders",
    "fact_order_items",
    "fact_inventory_items",
)

Tables = Mapping[str, DataFrame]

MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    "dws_clickstream_window_agg": lambda t: clickstream.window_summary(t["dwd_clickstream_events"]),
    "dws_clickstream_sessions": lambda t: clickstream.sessions(t["dwd_clickstream_events"], t["dim_products"]),
    "dws_sales_performance_flat": lambda t: sales.sales_flat(
        t["fact_order_items"], t["dim_products"], t["dim_users"], t["dim_distribution_centers"], t["fact_orders"]
    ),
    "dws_sales_overview_hourly": lambda t: sales.sales_summary(
        t["fact_order_items"], t["dim_products"], t["dim_users"]
    ),
    "dws_product_performance": lambda t: products.product_performance(
        t["dim_products"], t["fact_order_items"], t["dwd_clickstream_events"]
    ),
    "dws_inventory_details": lambda t: inventory.inventory_details(
        t["fact_inventory_items"], t["dim_distribution_centers"]
    ),
}

#: Marts that are worth storing: they group all detail and change slowly.
STORED = ("dws_clickstream_sessions", "dws_sales_overview_hourly")


def create_views(spark: SparkSession, tables: Tables, stored_at: str | None = None) -> None:
    """Make the tables and the six marts available to ``spark.sql``.

    With ``stored_at`` the stored marts are read from the copies that ``refresh_stored`` wrote.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name, build in MARTS.items():
        if stored_at is not None and name in STORED:
            df = read_current(spark, f"{stored_at}/{name}")
        else:
            df = build(tables)
        df.createOrReplaceTempView(name)


def refresh_stored(tables: Tables, path: str) -> None:
    """Rewrite the stored marts. To be called by whatever schedules jobs, every few minutes."""
    for name in STORED:
        refresh(MARTS[name](tables), f"{path}/{name}")
