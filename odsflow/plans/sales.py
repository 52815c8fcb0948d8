"""Sales detail and hourly sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odsflow.functions.measures import count_where, ratio
from odsflow.functions.times import days_between
from odsflow.operators.bitmaps import distinct_counts, id_bitmaps
from odsflow.operators.joins import lookup_join
from odsflow.schemas import UNSOLD_STATUSES


def sales_flat(
    items: DataFrame,
    products: DataFrame,
    users: DataFrame,
    centres: DataFrame,
    orders: DataFrame | None = None,
) -> DataFrame:
    """One row per order item with its product, user, centre and order.

    ``orders`` may be left out when the items already carry ``order_status`` and
    ``order_num_of_items``. Items without ``user_id`` and ``created_at`` get them from their order;
    users are then joined to the orders, which are fewer, so items are shuffled once less.
    """
    products = products.select(
        "product_id",
        F.col("cost").alias("product_cost"),
        F.col("retail_price").alias("product_retail_price"),
        F.col("name").alias("product_name"),
        F.col("category").alias("product_category"),
        F.col("brand").alias("product_brand"),
        F.col("department").alias("product_department"),
        F.col("sku").alias("product_sku"),
        "distribution_center_id",
    )
    users = users.select(
        "user_id",
        *[F.col(c).alias(f"user_{c}") for c in ("age", "gender", "city", "state", "country", "traffic_source")],
    )
    centres = centres.select(
        F.col("id").alias("distribution_center_id"), F.col("name").alias("distribution_center_name")
    )
    bare = "user_id" not in items.columns
    if orders is not None:
        orders = orders.select(
            "order_id",
            F.col("num_of_item").alias("order_num_of_items"),
            F.col("status").alias("order_status"),
            *(["user_id", "created_at"] if bare else []),
        )
        items = lookup_join(items, lookup_join(orders, users, "user_id") if bare else orders, "order_id")
    joined = lookup_join(items, products, "product_id")
    joined = joined if bare else lookup_join(joined, users, "user_id")
    joined = lookup_join(joined, centres, "distribution_center_id")
    return joined.select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "user_id",
        "product_id",
        "inventory_item_id",
        F.col("status").alias("order_item_status"),
        F.col("created_at").alias("order_item_created_at"),
        F.col("created_at").cast("date").alias("order_item_date"),
        F.col("shipped_at").alias("order_item_shipped_at"),
        F.col("delivered_at").alias("order_item_delivered_at"),
        F.col("returned_at").alias("order_item_returned_at"),
        "sale_price",
        "product_cost",
        "product_retail_price",
        _profit("product_cost").alias("product_profit"),
        ratio(_profit("product_cost"), F.col("sale_price")).alias("profit_margin"),
        "product_name",
        "product_category",
        "product_brand",
        "product_department",
        "product_sku",
        "user_age",
        "user_gender",
        "user_city",
        "user_state",
        "user_country",
        "user_traffic_source",
        "distribution_center_name",
        "order_num_of_items",
        "order_status",
        days_between("shipped_at", "delivered_at").alias("delivery_lead_time_days"),
        days_between("created_at", "shipped_at").alias("shipping_lead_time_days"),
    )


#: Group keys of the hourly summary and the table each one comes from.
_HOURLY_KEYS = {
    "order_hour": (None, lambda: F.date_trunc("hour", F.col("created_at").cast("timestamp"))),
    "order_date": (None, lambda: F.col("created_at").cast("date")),
    "product_category": ("product", lambda: F.col("category")),
    "product_department": ("product", lambda: F.col("department")),
    "user_country": ("user", lambda: F.col("country")),
    "user_gender": ("user", lambda: F.col("gender")),
}

#: Measures of the hourly summary and whether they need the product.
_HOURLY_MEASURES = {
    "total_items_ordered": (False, lambda: F.count("id")),
    "total_revenue": (False, lambda: F.sum("sale_price")),
    "total_cost": (True, lambda: F.sum("cost")),
    "total_profit": (True, lambda: _sum_profit(F.lit(True))),
    "total_orders": (False, lambda: F.countDistinct("order_id")),
    "total_customers": (False, lambda: F.countDistinct("user_id")),
    "returned_items": (False, lambda: count_where(F.col("status") == "Returned")),
    "cancelled_items": (False, lambda: count_where(F.col("status") == "Cancelled")),
    "net_revenue": (False, lambda: sum_kept(F.sum(F.when(is_kept(), F.col("sale_price"))))),
    "net_profit": (True, lambda: sum_kept(_sum_profit(is_kept()))),
}


def sales_summary(
    items: DataFrame,
    products: DataFrame,
    users: DataFrame,
    keys: tuple[str, ...] = tuple(_HOURLY_KEYS),
    measures: tuple[str, ...] = tuple(_HOURLY_MEASURES),
    orders: DataFrame | None = None,
) -> DataFrame:
    """Sales by any of the summary's keys.

    With all keys and measures this is the hourly summary. A roll-up is computed from the
    items too: sums would survive a second grouping, but distinct counts would not. Tables
    that no key and no measure needs are not joined; each has one row per key, so that
    leaves the result as it is.

    Items without ``user_id`` and ``created_at`` get them from ``orders``, one row per order. The
    items of an order then meet where it was joined and are grouped there: an order is one row of
    each group, and only customers are left to be counted as distinct.
    """
    needs = {_HOURLY_KEYS[key][0] for key in keys}
    if "product" in needs or any(_HOURLY_MEASURES[m][0] for m in measures):
        items = lookup_join(items, products.select("product_id", "category", "department", "cost"), "product_id")
    buyers = users.select("user_id", "country", "gender")
    if orders is not None:
        orders = orders.select("order_id", "user_id", "created_at")
        items = lookup_join(items, lookup_join(orders, buyers, "user_id") if "user" in needs else orders, "order_id")
    elif "user" in needs:
        items = lookup_join(items, buyers, "user_id")
    # The hour implies the date, so the date need not widen the grouping key.
    implied = {"order_date"} if {"order_hour", "order_date"} <= set(keys) else set()
    by = [_HOURLY_KEYS[key][1]().alias(key) for key in keys if key not in implied]
    made = {m: _HOURLY_MEASURES[m][1]() for m in measures}
    if orders is not None:
        sums = [m for m in measures if m in ADDITIVE]
        items = items.groupBy(*by, "order_id", "user_id").agg(*[made[m].alias(m) for m in sums])
        by = [key for key in keys if key not in implied]
        made |= {m: F.sum(m) for m in sums}
        made |= {"total_orders": F.count("order_id")} if "total_orders" in made else {}
    grouped = items.groupBy(*by).agg(*[column.alias(m) for m, column in made.items()])
    if implied:
        grouped = grouped.withColumn("order_date", F.col("order_hour").cast("date"))
    return grouped.select(*keys, *measures)


# -- roll-ups ----------------------------------------------------------------

#: Measures that survive a second sum.
ADDITIVE = (
    "total_items_ordered", "total_revenue", "total_cost", "total_profit", "returned_items", "cancelled_items",
    "net_revenue", "net_profit",
)
#: Distinct counts of the summary and the ids they count.
DISTINCT = {"total_orders": "order_id", "total_customers": "user_id"}


def hourly_sums(items: DataFrame, products: DataFrame, users: DataFrame) -> DataFrame:
    """Additive measures of every hour, to be stored."""
    return sales_summary(items, products, users, ("order_hour",), ADDITIVE)


def hourly_ids(items: DataFrame) -> DataFrame:
    """Orders and customers of every hour as bitmaps, to be stored. Nothing is joined."""
    hours = items.select(_HOURLY_KEYS["order_hour"][1]().alias("order_hour"), *DISTINCT.values())
    return id_bitmaps(hours, ["order_hour"], DISTINCT)


def roll_up(sums: DataFrame, ids: DataFrame, period: str | None) -> DataFrame:
    """All measures of the summary by ``day``, ``month`` or any other unit of time, or in total, from the two
    hourly tables alone. Sums are added up and bitmaps merged, so distinct counts are exact."""
    start = (F.lit(None).cast("timestamp") if period is None else F.date_trunc(period, F.col("order_hour"))).alias("period")
    counts = distinct_counts(ids.select(start, "what", "bucket", "bits"), ["period"], list(DISTINCT))
    counts = counts.withColumnRenamed("period", "of")
    added = sums.groupBy(start.alias("period")).agg(*[F.sum(m).alias(m) for m in ADDITIVE])
    joined = added.join(counts, F.col("period").eqNullSafe(F.col("of")), "left")
    zero = {name: F.coalesce(name, F.lit(0)) for name in DISTINCT}
    return joined.withColumns(zero).select("period", *ADDITIVE, *DISTINCT)


def since_newest_hours(items: DataFrame, hours: int) -> DataFrame:
    """Items of the newest ``hours`` that have any.

    The bound is a scalar subquery over the times alone, so that everything after it, joins
    included, sees only those hours and stored tables skip older files.
    """
    newest = (
        items.where(F.col("created_at").isNotNull())
        .select(F.date_trunc("hour", F.col("created_at").cast("timestamp")).cast("timestamp_ntz").alias("hour"))
        .distinct()
        .orderBy(F.desc("hour"))
        .limit(hours)
    )
    return items.where(F.col("created_at") >= newest.agg(F.min("hour")).scalar())


def _profit(cost: str) -> Column:
    return F.col("sale_price") - F.col(cost)


def _sum_profit(condition: Column) -> Column:
    # Two sums instead of a sum of differences: the columns keep their type, and decimals of
    # few digits are then added up as whole numbers.
    known = condition & F.col("sale_price").isNotNull() & F.col("cost").isNotNull()
    return F.sum(F.when(known, F.col("sale_price"))) - F.sum(F.when(known, F.col("cost")))


def is_kept(status: str = "status") -> Column:
    """Neither cancelled nor returned."""
    return ~F.col(status).isin(*UNSOLD_STATUSES)


def sum_kept(total: Column) -> Column:
    """A sum over kept items, to which the others of the group contribute zero."""
    others = F.count_if(F.coalesce(~is_kept(), F.lit(True)))
    return F.coalesce(total, F.when(others > 0, F.lit(0)))
