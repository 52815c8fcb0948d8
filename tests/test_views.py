from __future__ import annotations

import pytest
from conftest import rows

from odsflow.operators import clicks
from odsflow.plans.views import MARTS, STORED, TABLES, create_views, refresh_stored


@pytest.fixture(scope="module")
def warehouse(tables):
    return {
        "dwd_clickstream_events": tables.events(),
        "ods_clickstream_deadletter": clicks.dead_letters(clicks.parse(tables.click_topic())),
        "dim_users": tables.users(),
        "dim_products": tables.products(),
        "dim_distribution_centers": tables.centres(),
        "fact_orders": tables.orders(),
        "fact_order_items": tables.order_items(),
        "fact_inventory_items": tables.inventory_items(),
    }


def test_views_answer_sql(spark, warehouse):
    assert set(warehouse) == set(TABLES)
    create_views(spark, warehouse)
    for name in (*TABLES, *MARTS):
        assert spark.sql(f"SELECT COUNT(*) FROM {name}").first()[0] > 0
    total = spark.sql("SELECT SUM(sale_price) FROM fact_order_items").first()[0]
    assert spark.sql("SELECT SUM(sale_price) FROM dws_sales_performance_flat").first()[0] == total
    assert spark.sql("SELECT SUM(total_revenue) FROM dws_sales_overview_hourly").first()[0] == total
    assert spark.sql("SELECT SUM(total_revenue) FROM dws_product_performance").first()[0] == total
    events = spark.sql("SELECT COUNT(*) FROM dwd_clickstream_events").first()[0]
    assert spark.sql("SELECT SUM(total_events) FROM dws_clickstream_window_agg").first()[0] == events
    assert spark.sql("SELECT SUM(event_count) FROM dws_clickstream_sessions").first()[0] == events


def test_orders_joined_or_carried_give_the_same(spark, tables, warehouse):
    from odsflow.plans.sales import sales_flat

    names = [c for c in warehouse["fact_order_items"].columns if c != "updated_at"]
    carried = tables.order_items(*names, "order_status", "order_num_of_items")
    dims = [warehouse[n] for n in ("dim_products", "dim_users", "dim_distribution_centers")]
    assert rows(sales_flat(carried, *dims)) == rows(MARTS["dws_sales_performance_flat"](warehouse))


def test_stored_marts(spark, warehouse, tmp_path):
    refresh_stored(warehouse, str(tmp_path))
    create_views(spark, warehouse, str(tmp_path))
    for name in STORED:
        assert rows(spark.table(name)) == rows(MARTS[name](warehouse))
