"""The driver's Parquet tables seen as warehouse tables.

Each method takes the columns wanted, and joins a second file only when one of them
comes from there. Times keep the zone-less type they have on disk, so that range
filters reach the Parquet scan. Money and lags are decimals: their sums do not depend
on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odsflow.functions.decoding import once
from odsflow.operators.joins import lookup_join

# --- fixed values -----------------------------------------------------------
SOURCES = ("Email", "Adwords", "Organic", "YouTube", "Facebook")
BROWSERS = ("IE", "Edge", "Chrome", "Safari", "Firefox", "Other")
USER_SOURCES = ("Organic", "Facebook", "Search", "Email", "Display")
CENTRES = 25
ROUTES = 20
# ----------------------------------------------------------------------------


def _money(column: str | Column) -> Column:
    # Sums of this type have 28 digits, so no total of real amounts overflows.
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def _pick_name(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number % len(names) + 1).cast("int"))


def _null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


class DriverTables:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    # -- dimensions ----------------------------------------------------------

    def centres(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("name"),
            _null("double").alias("latitude"),
            _null("double").alias("longitude"),
        )

    def products(self) -> DataFrame:
        retail = _money("p_retailprice")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            _money(retail * F.lit("0.60").cast("decimal(3,2)")).alias("cost"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            retail.alias("retail_price"),
            F.when(F.col("p_size") <= 25, "Men").otherwise("Women").alias("department"),
            F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku"),
            (F.col("p_partkey") % CENTRES).alias("distribution_center_id"),
        )

    def users(self, *columns: str) -> DataFrame:
        customers = self.raw("customer")
        if not columns or "country" in columns:
            nations = self.raw("nation").select(
                F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
            )
            customers = lookup_join(customers, nations, "c_nationkey")
        key = F.col("c_custkey")
        created = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((key % 365).cast("int"))
        made = {
            "user_id": key,
            "first_name": F.lit("Customer"),
            "last_name": key.cast("string"),
            "email": F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")),
            "age": (12 + key % 59).cast("int"),
            "gender": F.when(key % 2 == 0, "F").otherwise("M"),
            "street_address": _null("string"),
            "postal_code": _null("string"),
            "city": F.col("c_name"),
            "state": F.col("c_mktsegment"),
            "country": F.col("country") if "country" in customers.columns else None,
            "latitude": _null("double"),
            "longitude": _null("double"),
            "traffic_source": _pick_name(USER_SOURCES, key),
            "created_at": created,
            "updated_at": created + F.make_dt_interval(F.lit(1)),
        }
        return _select(customers, made, columns)

    # -- facts ---------------------------------------------------------------

    def orders(self, *columns: str) -> DataFrame:
        orders = self.raw("orders")
        if not columns or "num_of_item" in columns:
            lines = (
                self.raw("lineitem")
                .groupBy(F.col("l_orderkey").alias("o_orderkey"))
                .agg(F.count(F.lit(1)).alias("lines"))
            )
            orders = orders.join(lines, "o_orderkey", "left")
        made = {
            "order_id": F.col("o_orderkey"),
            "user_id": F.col("o_custkey"),
            "status": F.when(F.col("o_orderstatus") == "F", "Complete")
            .when(F.col("o_orderstatus") == "O", "Processing")
            .otherwise("Shipped"),
            "gender": F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M"),
            "created_at": F.col("o_orderdate"),
            "updated_at": _null("timestamp_ntz"),
            "returned_at": _null("timestamp_ntz"),
            "shipped_at": _null("timestamp_ntz"),
            "delivered_at": _null("timestamp_ntz"),
            "num_of_item": F.coalesce(F.col("lines"), F.lit(0)).cast("int") if "lines" in orders.columns else None,
        }
        return _select(orders, made, columns)

    def order_items(self, *columns: str) -> DataFrame:
        """Order items. ``order_status`` and ``order_num_of_items`` may be asked for as well:
        they are then taken from the same join that brings the user and the order time."""
        lines = self.raw("lineitem")
        extra = {"order_status", "order_num_of_items"} & set(columns)
        if not columns or extra or {"user_id", "created_at"} & set(columns):
            wanted = ["order_id", "user_id", "created_at"]
            wanted += ["status"] if "order_status" in extra else []
            wanted += ["num_of_item"] if "order_num_of_items" in extra else []
            names = {"status": "order_status", "num_of_item": "order_num_of_items"}
            orders = self.orders(*wanted).withColumnsRenamed(names)
            lines = lookup_join(lines.withColumnRenamed("l_orderkey", "order_id"), orders, "order_id")
        else:
            lines = lines.withColumnRenamed("l_orderkey", "order_id")
        flag, line_status = F.col("l_returnflag"), F.col("l_linestatus")
        status = (
            F.when(flag == "R", "Returned")
            .when((flag == "A") & (line_status == "O"), "Cancelled")
            .when(flag == "A", "Complete")
            .when(line_status == "F", "Shipped")
            .otherwise("Processing")
        )
        shipped = F.col("l_shipdate")
        delivered = F.when(
            status.isin("Complete", "Returned"), shipped + F.make_dt_interval(F.col("l_linenumber") + 1)
        )
        returned = F.when(status == "Returned", shipped + F.make_dt_interval(F.col("l_linenumber") + 2))
        one = F.lit(1).cast("decimal(8,2)")
        made = {
            "id": _line_id(F.col("order_id")),
            "order_id": F.col("order_id"),
            "user_id": F.col("user_id") if "user_id" in lines.columns else None,
            "product_id": F.col("l_partkey"),
            "inventory_item_id": _line_id(F.col("order_id")),
            "status": status,
            "created_at": F.col("created_at") if "created_at" in lines.columns else None,
            "updated_at": F.coalesce(returned, delivered, shipped),
            "shipped_at": shipped,
            "delivered_at": delivered,
            "returned_at": returned,
            "sale_price": _money(_money("l_extendedprice") * (one - _money("l_discount"))),
        }
        made.update({name: F.col(name) for name in extra})
        return _select(lines, made, columns)

    def inventory_items(self, *columns: str) -> DataFrame:
        lines = self.raw("lineitem")
        if not columns or "created_at" in columns:
            times = self.raw("orders").select(
                F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("created_at")
            )
            lines = lookup_join(lines, times, "l_orderkey")
        copied = {
            "cost": "cost",
            "product_category": "category",
            "product_name": "name",
            "product_brand": "brand",
            "product_retail_price": "retail_price",
            "product_department": "department",
            "product_sku": "sku",
        }
        if not columns or set(copied) & set(columns):
            parts = self.products().withColumnRenamed("product_id", "l_partkey")
            lines = lookup_join(lines, parts, "l_partkey")
        made = {
            "id": _line_id(F.col("l_orderkey")),
            "product_id": F.col("l_partkey"),
            "created_at": F.col("created_at") if "created_at" in lines.columns else None,
            "sold_at": F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")),
            **{name: F.col(source) for name, source in copied.items() if source in lines.columns},
            "product_distribution_center_id": F.col("l_partkey") % CENTRES,
        }
        return _select(lines, made, columns)

    # -- clicks --------------------------------------------------------------

    def events(self) -> DataFrame:
        kind, k = F.col("event_type"), F.col("k")
        event_type = (
            F.when(kind == "view", "product")
            .when(kind == "click", "cart")
            .when(kind == "purchase", "purchase")
            .when(kind == "signup", "home")
            .otherwise("cancel")
        )
        lag = F.col("value").cast("decimal(18,6)")
        ingested = F.col("ts") + F.make_dt_interval(secs=lag)
        return self._raw_events().select(
            "event_id",
            F.col("ts").alias("event_timestamp"),
            "user_id",
            k.cast("int").alias("sequence_number"),
            _session_id().alias("session_id"),
            _null("string").alias("ip_address"),
            _null("string").alias("city"),
            _null("string").alias("state"),
            _null("string").alias("postal_code"),
            _pick_name(BROWSERS, F.col("user_id")).alias("browser"),
            _pick_name(SOURCES, F.col("user_id")).alias("traffic_source"),
            self._uri().alias("uri"),
            event_type.alias("event_type"),
            F.to_date("ts").alias("event_date"),
            ingested.alias("ingested_at"),
            F.when(event_type == "cancel", "post_purchase").otherwise(event_type).alias("page_type"),
            F.when(event_type == "product", k).alias("product_id"),
            (event_type == "purchase").alias("is_conversion"),
            ingested.alias("processing_time"),
            lag.alias("event_lag_seconds"),
        )

    def click_topic(self) -> DataFrame:
        """Events as messages of the click topic, with the faults a real topic has.

        The type ``error`` has no counterpart and stays as it is, so it is invalid.
        Depending on the number ``k`` in the event: 0 breaks the JSON, 1 leaves the
        session out, 2 makes the id a word, 3 makes the time unreadable, 4 sends
        empty text and 5 sends no value at all.
        """
        k, kind = F.col("k"), F.col("event_type")
        event_type = (
            F.when(kind == "view", "product")
            .when(kind == "click", "cart")
            .when(kind == "signup", "home")
            .otherwise(kind)
        )
        session = F.when(k == 1, F.lit("null")).otherwise(_quoted(_session_id()))
        identity = F.when(k == 2, F.lit('"x"')).otherwise(F.col("event_id").cast("string"))
        created = F.when(k == 3, F.lit("bad")).otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        )
        body = F.concat(
            F.lit('{"id": '), identity,
            F.lit(', "user_id": '), F.col("user_id").cast("string"),
            F.lit(', "session_id": '), session,
            F.lit(', "browser": '), _quoted(_pick_name(BROWSERS, F.col("user_id"))),
            F.lit(', "traffic_source": '), _quoted(_pick_name(SOURCES, F.col("user_id"))),
            F.lit(', "uri": '), _quoted(self._uri()),
            F.lit(', "event_type": '), _quoted(event_type),
            F.lit(', "created_at": '), _quoted(created),
            F.when(k == 0, F.lit("")).otherwise("}"),
        )
        text = F.when(k == 5, None).when(k == 4, "").otherwise(body)
        return self._raw_events().select(
            _session_id().alias("key"),
            once(text.cast("binary"), "value"),
            F.lit("clickstream-events").alias("topic"),
            (F.col("user_id") % 4).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )

    def user_changes(self) -> DataFrame:
        """Events as changes of the user that caused them, in messages of a change topic.

        ``error`` deletes the user and sends only the key, other types write the row.
        Half of the messages have a ``payload`` around them. Depending on the number
        ``k``: 0 has neither image, 1 has no value (a tombstone), 2 has no key.
        """
        k, kind = F.col("k"), F.col("event_type")
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
        key = F.when(k == 2, F.lit("null")).otherwise(F.col("user_id").cast("string"))
        row = F.concat(
            F.lit('{"id": '), key,
            F.lit(', "age": '), k.cast("string"),
            F.lit(', "traffic_source": '), _quoted(kind),
            F.lit(', "latitude": '), F.col("value").cast("decimal(18,2)").cast("string"),
            F.lit(', "created_at": '), micros.cast("string"),
            F.lit(', "updated_at": '), (micros + 1).cast("string"),
            F.lit("}"),
        )
        only_key = F.concat(F.lit('{"id": '), key, F.lit("}"))
        null = F.lit("null")
        deletes = kind == "error"
        body = F.concat(
            F.lit('{"before": '), F.when(deletes & (k != 0), only_key).otherwise(null),
            F.lit(', "after": '), F.when(deletes | (k == 0), null).otherwise(row),
            F.lit(', "op": '),
            F.when(deletes, F.lit('"d"')).when(kind == "signup", F.lit('"c"')).otherwise(F.lit('"u"')),
            F.lit("}"),
        )
        wrapped = F.when(k % 2 == 0, F.concat(F.lit('{"payload": '), body, F.lit("}"))).otherwise(body)
        return self._raw_events().select(
            F.col("user_id").cast("string").alias("key"),
            once(F.when(k != 1, wrapped).cast("binary"), "value"),
            F.lit("cdc.demo.users").alias("topic"),
            (F.col("user_id") % 4).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )

    def _raw_events(self) -> DataFrame:
        """Events with the number in ``props`` as ``k``."""
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))

    @staticmethod
    def _uri() -> Column:
        k, kind = F.col("k").cast("string"), F.col("event_type")
        return (
            F.when(kind == "view", F.concat(F.lit("/product/"), k))
            .when(kind == "click", "/cart")
            .when(kind == "purchase", "/purchase")
            .when(kind == "signup", "/home")
            .otherwise(F.concat(F.lit("/cancel/item/"), k))
        )

    # -- trips ---------------------------------------------------------------

    def trips(self) -> DataFrame:
        start = F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))
        minutes = F.col("l_quantity")
        km = (_money("l_extendedprice") * F.lit("0.001").cast("decimal(3,3)")).cast("decimal(18,5)")
        route = F.col("l_suppkey") % ROUTES
        return self.raw("lineitem").select(
            F.to_date("l_shipdate").alias("date"),
            F.concat(F.lit("V"), F.col("l_suppkey").cast("string")).alias("vehicle"),
            route.cast("int").alias("route_id"),
            route.cast("string").alias("route_no"),
            F.col("l_orderkey").alias("trip_id"),
            start.alias("start_time"),
            (start + F.make_dt_interval(mins=minutes.cast("int"))).alias("end_time"),
            minutes.alias("trip_duration_minutes"),
            km.alias("total_distance_km"),
            F.col("l_linestatus").alias("direction"),
            F.col("l_returnflag").alias("confidence_score"),
            F.col("l_shipdate").alias("updated_at"),
        )

    def gps_points(self) -> DataFrame:
        speed = (
            F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.col("value")).cast("decimal(18,2)")
        )
        hour, weekday = F.hour("ts"), F.weekday("ts") + 1
        return self._raw_events().select(
            F.to_date("ts").alias("date"),
            F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle"),
            (F.col("user_id") % ROUTES).cast("string").alias("route_no"),
            hour.alias("hour"),
            weekday.alias("day_of_week"),
            F.when(weekday <= 5, "weekday").otherwise("weekend").alias("day_type"),
            F.when(hour.isin(7, 8, 9, 17, 18, 19), 1).otherwise(0).alias("is_peak_hour"),
            speed.alias("speed"),
            F.when(speed == 0, "stopped")
            .when(speed < 20, "slow")
            .when(speed < 60, "normal")
            .otherwise("fast")
            .alias("speed_level"),
            F.when(speed > 0, 1).otherwise(0).alias("is_moving"),
            F.when(speed > 0, 0).otherwise(1).alias("is_stopped"),
            (F.col("k") / F.lit(100.0)).alias("x"),
            (F.col("user_id") / F.lit(100.0)).alias("y"),
            F.col("ts").alias("updated_at"),
        )


def _line_id(order_id: Column) -> Column:
    return order_id * 10 + F.col("l_linenumber")


def _session_id() -> Column:
    return F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _select(df: DataFrame, made: dict[str, Column | None], columns: tuple[str, ...]) -> DataFrame:
    return df.select(*[made[name].alias(name) for name in columns or made])
