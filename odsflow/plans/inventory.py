"""Inventory with its centre, stock flags and time to sell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odsflow.functions.times import whole_units_between
from odsflow.operators.joins import lookup_join


def inventory_details(inventory: DataFrame, centres: DataFrame) -> DataFrame:
    names = centres.select(
        F.col("id").alias("product_distribution_center_id"),
        F.col("name").alias("distribution_center_name"),
    )
    sold = F.col("sold_at").isNotNull()
    return lookup_join(inventory, names, "product_distribution_center_id").select(
        F.col("id").alias("inventory_item_id"),
        "product_id",
        F.col("created_at").alias("inventory_created_at"),
        F.col("created_at").cast("date").alias("inventory_created_date"),
        F.col("sold_at").alias("inventory_sold_at"),
        F.col("sold_at").cast("date").alias("inventory_sold_date"),
        "cost",
        "product_category",
        "product_name",
        "product_brand",
        F.col("product_retail_price").alias("retail_price"),
        "product_department",
        "product_sku",
        "distribution_center_name",
        F.when(sold, 0).otherwise(1).alias("is_stock_on_hand"),
        F.when(sold, 1).otherwise(0).alias("is_sold"),
        whole_units_between("DAY", "created_at", "sold_at").alias("days_to_sell"),
    )
