"""Product performance: catalogue, sales and page views side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odsflow.functions.measures import count_where, ratio
from odsflow.plans.sales import is_kept, sum_kept


def product_sales(items: DataFrame) -> DataFrame:
    price = F.col("sale_price")
    return items.groupBy("product_id").agg(
        F.count("id").alias("total_items_ordered"),
        count_where(is_kept()).alias("net_items_sold"),
        F.sum(price).alias("total_revenue"),
        sum_kept(F.sum(F.when(is_kept(), price))).alias("net_revenue"),
        count_where(F.col("status") == "Returned").alias("total_returned_items"),
        count_where(F.col("status") == "Cancelled").alias("total_cancelled_items"),
    )


def product_views(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("event_type") == "product")
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("total_page_views"),
            F.countDistinct("session_id").alias("unique_view_sessions"),
        )
    )


def product_performance(products: DataFrame, items: DataFrame, events: DataFrame) -> DataFrame:
    """Every product of the catalogue, with zeros where it was never sold or seen.

    Sales and views are grouped before the joins, so each side has one row per product.
    """
    joined = products.join(product_sales(items), "product_id", "left").join(
        product_views(events), "product_id", "left"
    )
    ordered, views = _zero("total_items_ordered"), _zero("total_page_views")
    unit_profit = F.col("retail_price") - F.col("cost")
    total_cost = ordered * F.col("cost")
    return joined.select(
        "product_id",
        F.col("name").alias("product_name"),
        F.col("category").alias("product_category"),
        F.col("brand").alias("product_brand"),
        F.col("department").alias("product_department"),
        F.col("sku").alias("product_sku"),
        "retail_price",
        "cost",
        unit_profit.alias("unit_profit"),
        ratio(unit_profit, F.col("retail_price")).alias("unit_margin"),
        ordered.alias("total_items_ordered"),
        _zero("net_items_sold").alias("net_items_sold"),
        _zero("total_revenue").alias("total_revenue"),
        _zero("net_revenue").alias("net_revenue"),
        total_cost.alias("total_cost"),
        (_zero("total_revenue") - total_cost).alias("total_profit"),
        _zero("total_returned_items").alias("total_returned_items"),
        _zero("total_cancelled_items").alias("total_cancelled_items"),
        ratio(_zero("total_returned_items"), ordered).alias("return_rate"),
        views.alias("total_page_views"),
        _zero("unique_view_sessions").alias("unique_view_sessions"),
        ratio(ordered, views).alias("view_to_order_conversion_rate"),
    )


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))
