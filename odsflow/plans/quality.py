"""Checks of tables against the rules of their source."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odsflow.schemas import EVENT_TYPES, ORDER_STATUSES, TEXT_LENGTHS

#: Table, primary key, and the rule set. A rule that is null passes, as a CHECK does.
RULES: dict[str, tuple[str, dict[str, str]]] = {
    "dim_products": ("product_id", {"prices_not_negative": "cost >= 0 AND retail_price >= 0"}),
    "dim_distribution_centers": ("id", {}),
    "dim_users": (
        "user_id",
        {
            "age_in_range": "age BETWEEN 12 AND 120",
            "updated_after_created": "updated_at >= created_at",
            "created_at_present": "created_at IS NOT NULL",
        },
    ),
    "fact_inventory_items": (
        "id",
        {
            "cost_not_negative": "cost >= 0",
            "sold_after_created": "sold_at IS NULL OR sold_at >= created_at",
            "created_at_present": "created_at IS NOT NULL",
        },
    ),
    "fact_orders": (
        "order_id",
        {
            "has_items": "num_of_item >= 1",
            "known_status": "status IN ({})".format(", ".join(f"'{s}'" for s in ORDER_STATUSES)),
            "created_at_present": "created_at IS NOT NULL",
        },
    ),
    "fact_order_items": (
        "id",
        {"sale_price_not_negative": "sale_price >= 0", "created_at_present": "created_at IS NOT NULL"},
    ),
    "dwd_clickstream_events": (
        "event_id",
        {
            "sequence_positive": "sequence_number >= 1",
            "known_event_type": "event_type IN ({})".format(", ".join(f"'{t}'" for t in EVENT_TYPES)),
            "created_at_present": "event_timestamp IS NOT NULL",
        },
    ),
}

#: Child table and column, parent table and key.
FOREIGN_KEYS = (
    ("dim_products", "distribution_center_id", "dim_distribution_centers", "id"),
    ("fact_inventory_items", "product_id", "dim_products", "product_id"),
    ("fact_inventory_items", "product_distribution_center_id", "dim_distribution_centers", "id"),
    ("fact_orders", "user_id", "dim_users", "user_id"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "user_id", "dim_users", "user_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_order_items", "inventory_item_id", "fact_inventory_items", "id"),
    ("dwd_clickstream_events", "user_id", "dim_users", "user_id"),
)


def check_rules(tables: dict[str, DataFrame], keys: dict[str, DataFrame] | None = None) -> DataFrame:
    """``(table_name, rule, violations)``.

    Row rules take one pass over a table and send one row per task. Keys are checked apart
    from them: in one aggregate, every key would carry the counters of all rules through
    the shuffle. ``keys`` may hold, per table, a narrower frame that has its key: what a table's
    other columns need, joins included, is then left out.
    """
    narrow = {**tables, **(keys or {})}
    checks = [(_row_rules(name, df), _key_rule(name, narrow[name])) for name, df in tables.items()]
    return _union([check for pair in checks for check in pair])


def _row_rules(name: str, df: DataFrame) -> DataFrame:
    broken: dict[str, Column] = {rule: F.count_if(~F.expr(test)) for rule, test in RULES[name][1].items()}
    for column, longest in TEXT_LENGTHS[name].items():
        broken[f"length_{column}"] = F.count_if(F.length(column) > longest)
    counted = df.agg(*[value.alias(rule) for rule, value in broken.items()])
    return counted.unpivot([], list(broken), "rule", "violations").select(
        F.lit(name).alias("table_name"), "rule", "violations"
    )


def _key_rule(name: str, df: DataFrame) -> DataFrame:
    """Rows without a key, and rows that repeat one."""
    key = RULES[name][0]
    counted = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg((F.coalesce(F.sum("n"), F.lit(0)) - F.count("key")).alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit("unique_key").alias("rule"), "violations"
    )


def check_foreign_keys(tables: dict[str, DataFrame | Callable[[str], DataFrame]]) -> DataFrame:
    """``(child_table, child_column, parent_table, violations)`` for every foreign key.

    Children are counted by key before the join, so that a hot key is one row, and what is
    shuffled is no more than the distinct keys. A table may be given as a function of the column
    that a check needs, so that other columns cost nothing.
    """
    def frame(name: str, column: str) -> DataFrame:
        found = tables[name]
        return found(column) if callable(found) else found

    results = []
    for child, column, parent, key in FOREIGN_KEYS:
        counted = (
            frame(child, column)
            .where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("fk"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        parents = frame(parent, key).select(F.col(key).alias("fk"))
        results.append(
            counted.join(parents, "fk", "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
            .select(
                F.lit(child).alias("child_table"),
                F.lit(column).alias("child_column"),
                F.lit(parent).alias("parent_table"),
                "violations",
            )
        )
    return _union(results)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
