"""Declared schemas: topics, tables, and the settings of each change feed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
EVENT_TYPES = ("home", "department", "category", "product", "cart", "purchase", "cancel", "return")
PAGEVIEW_TYPES = ("home", "department", "category", "product")
ORDER_STATUSES = ("Processing", "Shipped", "Complete", "Cancelled", "Returned")
UNSOLD_STATUSES = ("Cancelled", "Returned")
CLICK_TOPIC = "clickstream-events"
CHANGE_TOPIC_PREFIX = "cdc.demo."
BAD_JSON = "Invalid JSON format"
BAD_FIELDS = "Missing required fields or invalid event_type"
BAD_TIME = "unparseable created_at"
# ----------------------------------------------------------------------------


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    # StructType.fromDDL needs a running session, and schemas are built at import.
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


#: Rows of a message topic, as the Kafka source delivers them.
TOPIC_ROW = _struct(
    "key string, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

#: JSON body of a click message.
CLICK = _struct(
    "id bigint, user_id bigint, sequence_number int, session_id string, ip_address string, "
    "city string, state string, postal_code string, browser string, traffic_source string, "
    "uri string, event_type string, created_at string"
)

#: Click detail table.
EVENTS = _struct(
    "event_id bigint, event_timestamp timestamp, user_id bigint, sequence_number int, "
    "session_id string, ip_address string, city string, state string, postal_code string, "
    "browser string, traffic_source string, uri string, event_type string, event_date date, "
    "ingested_at timestamp, page_type string, product_id bigint, is_conversion boolean, "
    "processing_time timestamp, event_lag_seconds double"
)

DEAD_LETTERS = _struct("failed_at timestamp, raw_message string, error_message string")

# Source rows as they appear inside a change envelope; times are epoch microseconds.
CENTRE_ROW = _struct("id bigint, name string, latitude double, longitude double")
PRODUCT_ROW = _struct(
    "id bigint, cost double, category string, name string, brand string, retail_price double, "
    "department string, sku string, distribution_center_id bigint"
)
USER_ROW = _struct(
    "id bigint, first_name string, last_name string, email string, age int, gender string, "
    "street_address string, postal_code string, city string, state string, country string, "
    "latitude double, longitude double, traffic_source string, created_at bigint, updated_at bigint"
)
INVENTORY_ROW = _struct(
    "id bigint, product_id bigint, created_at bigint, sold_at bigint, cost double, "
    "product_category string, product_name string, product_brand string, "
    "product_retail_price double, product_department string, product_sku string, "
    "product_distribution_center_id bigint"
)
ORDER_ROW = _struct(
    "order_id bigint, user_id bigint, status string, gender string, created_at bigint, "
    "updated_at bigint, returned_at bigint, shipped_at bigint, delivered_at bigint, num_of_item int"
)
ORDER_ITEM_ROW = _struct(
    "id bigint, order_id bigint, user_id bigint, product_id bigint, inventory_item_id bigint, "
    "status string, created_at bigint, updated_at bigint, shipped_at bigint, delivered_at bigint, "
    "returned_at bigint, sale_price double"
)

#: Columns that hold times wherever they occur in a change feed.
TIME_COLUMNS = frozenset(
    {"created_at", "updated_at", "sold_at", "returned_at", "shipped_at", "delivered_at", "event_timestamp"}
)


@dataclass(frozen=True)
class ChangeFeed:
    """One change topic and the keyed table it feeds."""

    source: str
    table: str
    row: T.StructType
    key: str
    renames: dict[str, str] = field(default_factory=dict)
    error_budget: int = 100
    max_rows_per_batch: int = 300_000
    interval: str = "5 seconds"

    @property
    def error_span(self) -> int:
        """Offsets in a row within which the budget holds: those of ten full batches."""
        return 10 * self.max_rows_per_batch

    @property
    def topic(self) -> str:
        return CHANGE_TOPIC_PREFIX + self.source

    @property
    def target_key(self) -> str:
        return self.renames.get(self.key, self.key)

    @property
    def columns(self) -> list[str]:
        return [self.renames.get(name, name) for name in self.row.fieldNames()]

    @property
    def target_schema(self) -> T.StructType:
        """Schema of the keyed table: renamed columns, times as timestamps."""
        return T.StructType(
            [
                T.StructField(
                    self.renames.get(f.name, f.name),
                    T.TimestampType() if f.name in TIME_COLUMNS else f.dataType,
                )
                for f in self.row.fields
            ]
        )


#: Parents before children, the order in which snapshots have to be loaded.
#: ``order_items`` is keyed on the source's primary key alone: a delete carries
#: only that key, so a key that included ``order_id`` would never match.
CHANGE_FEEDS = {
    feed.source: feed
    for feed in (
        ChangeFeed("distribution_centers", "dim_distribution_centers", CENTRE_ROW, "id"),
        ChangeFeed("products", "dim_products", PRODUCT_ROW, "id", {"id": "product_id"}),
        ChangeFeed("users", "dim_users", USER_ROW, "id", {"id": "user_id"}),
        ChangeFeed("inventory_items", "fact_inventory_items", INVENTORY_ROW, "id"),
        ChangeFeed("orders", "fact_orders", ORDER_ROW, "order_id"),
        ChangeFeed("order_items", "fact_order_items", ORDER_ITEM_ROW, "id"),
    )
}

#: Longest text each column of a target table may hold.
TEXT_LENGTHS = {
    "dwd_clickstream_events": {
        "session_id": 50,
        "ip_address": 50,
        "city": 100,
        "state": 100,
        "postal_code": 20,
        "browser": 50,
        "traffic_source": 50,
        "uri": 500,
        "event_type": 50,
        "page_type": 50,
    },
    "dim_users": {
        "first_name": 100,
        "last_name": 100,
        "email": 255,
        "gender": 10,
        "street_address": 255,
        "postal_code": 20,
        "city": 100,
        "state": 100,
        "country": 100,
        "traffic_source": 50,
    },
    "dim_products": {"category": 100, "name": 255, "brand": 100, "department": 100, "sku": 100},
    "dim_distribution_centers": {"name": 100},
    "fact_orders": {"status": 50, "gender": 10},
    "fact_order_items": {"status": 50},
    "fact_inventory_items": {
        "product_category": 100,
        "product_name": 255,
        "product_brand": 100,
        "product_department": 100,
        "product_sku": 100,
    },
}
