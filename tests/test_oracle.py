"""Every named query against its SQL on the smallest data set."""

from __future__ import annotations

import pytest
from conftest import DATA
from oracle_check import compare, connect

from odsflow.registry import QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_same_rows_as_sql(spark, connection, name):
    assert compare(QUERIES[name].run(spark, DATA), connection, QUERIES[name].sql) == []


# Queries with a second way for tables that cannot be broadcast.
LARGE = [
    "sessions",
    "session_top_category",
    "dash_funnel_by_category",
    "cdc2_revenue_by_category",
    "cdc4_orders_by_demographic",
    "cdc5_stock_by_centre",
    "sales_flat",
    "sales_hourly",
    "product_performance",
    "q3_trending",
    "dq_foreign_keys",
    "unique_key_delete",
    "colocated_join",
]


@pytest.mark.parametrize("name", LARGE)
def test_same_rows_without_broadcast(spark, connection, no_broadcast, name):
    assert compare(QUERIES[name].run(spark, DATA), connection, QUERIES[name].sql) == []
