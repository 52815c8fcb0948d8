"""Ingest, keyed tables, storage and checks."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from odsflow.functions import clicks as click_functions
from odsflow.operators import changes, clicks, ingest, keyed, offsets
from odsflow.operators.selection import retained
from odsflow.plans import clickstream, quality
from odsflow.registry.base import add
from odsflow.schemas import CHANGE_FEEDS, EVENTS
from odsflow.sinks import paths, refresh
from odsflow.sinks.append import read_batches
from odsflow.sinks.layout import ColocatedPair, drop_expired_batches, write_clustered
from odsflow.sources.snapshots import read_csv, rejected_csv
from odsflow.sources.topics import read_topic_files
from odsflow.streaming import changes as change_streams
from odsflow.streaming import clicks as click_streams

USERS = CHANGE_FEEDS["users"]

# -- click ingest ------------------------------------------------------------


@add(
    "validate_events",
    """SELECT verdict = 'valid' AS is_accepted, COUNT(*) AS messages FROM click_messages
       WHERE verdict <> 'none' GROUP BY 1""",
)
def _(t):
    parsed = clicks.parse(t.click_topic())
    both = clicks.valid(parsed).select(F.lit(True).alias("is_accepted")).unionByName(
        clicks.dead_letters(parsed).select(F.lit(False).alias("is_accepted"))
    )
    return both.groupBy("is_accepted").agg(F.count(F.lit(1)).alias("messages"))


@add(
    "deadletter_rows",
    """SELECT raw_message, verdict AS error_message FROM click_messages WHERE verdict NOT IN ('valid', 'none')""",
)
def _(t):
    return clicks.dead_letters(clicks.parse(t.click_topic())).drop("failed_at")




@add(
    "uri_page_type",
    """SELECT uri, CASE WHEN part IN ('cancel', 'return') THEN 'post_purchase' WHEN uri IS NULL OR uri = '' THEN 'unknown'
              ELSE part END AS page_type, COUNT(*) AS events
       FROM (SELECT uri, string_split(regexp_replace(uri, '^/|/$', '', 'g'), '/')[1] AS part FROM click_events)
       GROUP BY ALL""",
)
def _(t):
    return (
        t.events()
        .select("uri", click_functions.page_type(F.col("uri")).alias("page_type"))
        .groupBy("uri", "page_type")
        .agg(F.count(F.lit(1)).alias("events"))
    )


@add(
    "uri_product_id",
    """SELECT event_id, CASE WHEN parts[1] = 'product' THEN TRY_CAST(parts[2] AS BIGINT) END AS product_id
       FROM (SELECT event_id, string_split(regexp_replace(uri, '^/|/$', '', 'g'), '/') AS parts FROM click_events)""",
)
def _(t):
    return t.events().select("event_id", click_functions.product_id(F.col("uri")).alias("product_id"))


_DETAIL = """event_id, ts AS event_timestamp, user_id, session AS session_id, browser, traffic_source, uri, event_type,
    CAST(ts AS DATE) AS event_date,
    CASE WHEN event_type = 'cancel' THEN 'post_purchase' ELSE event_type END AS page_type,
    CASE WHEN event_type = 'product' THEN k END AS product_id, event_type = 'purchase' AS is_conversion"""
_DETAIL_NAMES = (
    "event_id", "event_timestamp", "user_id", "session_id", "browser", "traffic_source", "uri", "event_type",
    "event_date", "page_type", "product_id", "is_conversion",
)


@add(
    "enrich_events",
    f"""SELECT {_DETAIL}, CAST(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts) AS DOUBLE) / 1000000
               AS event_lag_seconds
        FROM click_messages WHERE verdict = 'valid'""",
)
def _(t):
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rows = clicks.enrich(clicks.valid(clicks.parse(t.click_topic())), at)
    # The lag is a difference of doubles; to the microsecond it is exact.
    return rows.select(*_DETAIL_NAMES, F.round("event_lag_seconds", 6).alias("event_lag_seconds"))


@add("dedup_events", f"SELECT {_DETAIL} FROM click_messages WHERE verdict = 'valid'")
def _(t):
    topic = t.click_topic()
    # The topic delivered twice has to give each event once.
    twice = clicks.valid(clicks.parse(topic.unionByName(topic)))
    return clicks.enrich(clicks.deduplicate(twice)).select(*_DETAIL_NAMES)


@add("stream_click_events", f"SELECT {_DETAIL} FROM click_messages WHERE verdict = 'valid'")
def _(t):
    folder = paths.scratch(t.spark, "click-stream")
    topic = t.click_topic()
    topic.unionByName(topic).write.parquet(f"{folder}/topic")
    query = click_streams.start_valid(
        read_topic_files(t.spark, f"{folder}/topic"), f"{folder}/events", f"{folder}/checkpoint", availableNow=True
    )
    query.awaitTermination()
    return read_batches(t.spark, f"{folder}/events", EVENTS).select(*_DETAIL_NAMES)


@add(
    "stream_window_counts",
    """SELECT window_start, window_end, traffic_source, browser, event_type, page_type, count(*) AS total_events FROM (
           SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + to_minutes(5) AS window_end,
                  traffic_source, browser, event_type, CASE WHEN event_type = 'cancel' THEN 'post_purchase' ELSE event_type END AS page_type
           FROM click_messages WHERE verdict = 'valid')
       WHERE window_end <= (SELECT max(ts) FROM click_messages WHERE verdict = 'valid') - to_minutes(10) GROUP BY ALL""",
)
def _(t):
    # Every message is delivered twice; windows count once the watermark has passed them.
    folder = paths.scratch(t.spark, "window-stream")
    topic = t.click_topic()
    topic.unionByName(topic).write.parquet(f"{folder}/topic")
    click_streams.start_window_counts(
        read_topic_files(t.spark, f"{folder}/topic"), f"{folder}/counts", f"{folder}/checkpoint", availableNow=True
    ).awaitTermination()
    counts = t.spark.read.option("basePath", f"{folder}/counts").parquet(f"{folder}/counts/batch_id=*")
    return counts.drop("batch_id", "approx_sessions", "approx_users")


@add(
    "topic_gaps",
    """SELECT topic, "partition", seen + 1 AS first_missing, event_id - 1 AS last_missing FROM (
           SELECT 'clickstream-events' AS topic, (user_id % 4)::BIGINT AS "partition", event_id,
                  lag(event_id) OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS seen FROM events)
       WHERE event_id > seen + 1""",
)
def _(t):
    # Users share one numbering here, so their partitions have gaps.
    return offsets.missing_offsets(t.click_topic(), block=1000)


# -- normalisation -----------------------------------------------------------

_RAW_CLICKS = """
    SELECT CAST(event_id AS VARCHAR) AS id,
           CASE WHEN k = 1 THEN NULL WHEN k = 2 THEN '' ELSE session END AS session_id,
           CASE WHEN k = 3 THEN NULL WHEN k = 4 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS created_at
    FROM click_messages"""
_NORMALISED_AT = "2024-02-01T00:00:00.000000"


@add(
    "ingest_normalise_events",
    f"""SELECT id, session_id, session_id AS key,
               CASE WHEN COALESCE(created_at, '') = '' THEN '{_NORMALISED_AT}' ELSE created_at END AS created_at,
               COALESCE(id, '') <> '' AND COALESCE(session_id, '') <> '' AS accepted
        FROM ({_RAW_CLICKS})""",
)
def _(t):
    k, events = F.col("sequence_number"), t.events()
    rows = events.select(
        F.col("event_id").cast("string").alias("id"),
        F.when(k == 2, "").when((k != 1) | k.isNull(), F.col("session_id")).alias("session_id"),
        F.when(k == 4, "")
        .when((k != 3) | k.isNull(), F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("created_at"),
    )
    return ingest.normalise_clicks(rows, F.lit("2024-02-01").cast("timestamp"))


@add(
    "ingest_normalise_users",
    f"""SELECT id, id AS key, COALESCE(id, '') <> '' AS accepted,
               CASE WHEN age = 12 THEN '{_NORMALISED_AT}' ELSE created_at END AS created_at,
               CASE WHEN age = 12 THEN '{_NORMALISED_AT}' ELSE updated_at END AS updated_at
        FROM (SELECT CAST(user_id AS VARCHAR) AS id, age, strftime(created_at, '%Y-%m-%d') AS created_at,
                     strftime(updated_at, '%Y-%m-%d') AS updated_at FROM dim_users)""",
)
def _(t):
    rows = t.users("user_id", "age", "created_at", "updated_at").select(
        F.col("user_id").cast("string").alias("id"),
        F.when(F.col("age") != 12, F.date_format("created_at", "yyyy-MM-dd")).alias("created_at"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated_at"),
    )
    return ingest.normalise_users(rows, F.lit("2024-02-01").cast("timestamp"))


@add(
    "shift_dates",
    "SELECT order_id, status, created_at + to_years(1) AS created_at FROM fact_orders",
)
def _(t):
    return ingest.shift_dates(t.orders("order_id", "status", "created_at"), 1)


# -- changes -----------------------------------------------------------------

# The change topic made from events: what each message says, and whether it is usable.
_CHANGES = """
    SELECT event_id AS offset_, CAST(ts AS DATE) AS batch, user_id, k, event_type = 'error' AS deletes,
           CASE WHEN event_type = 'error' THEN NULL ELSE k END AS age,
           CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS traffic_source,
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS latitude,
           CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS created_at,
           CASE WHEN event_type = 'error' THEN NULL ELSE ts + to_microseconds(1) END AS updated_at
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""
_USER_COLUMNS = ("user_id", "age", "traffic_source", "latitude", "created_at", "updated_at")
_USER_LIST = ", ".join(_USER_COLUMNS)


def _flat(t, *keep: str):
    return changes.flatten(changes.decode(t.user_changes(), USERS, *keep), USERS, *keep)


@add(
    "cdc_flatten",
    f"""SELECT offset_ AS offset, CASE WHEN k <> 2 THEN user_id END AS user_id, age, traffic_source, latitude,
               CAST(deletes AS BIGINT) AS is_deleted
        FROM ({_CHANGES}) WHERE k NOT IN (0, 1)""",
)
def _(t):
    return _flat(t, "offset").select("offset", "user_id", "age", "traffic_source", "latitude", "is_deleted")


@add(
    "cdc_timestamps",
    f"SELECT offset_ AS offset, created_at, updated_at FROM ({_CHANGES}) WHERE k NOT IN (0, 1)",
)
def _(t):
    return _flat(t, "offset").select("offset", "created_at", "updated_at")


@add(
    "cdc_error_budget",
    f"""SELECT batch, SUM(CASE WHEN k IN (0, 2) THEN 1 ELSE 0 END)::BIGINT AS rejected, COUNT(*) AS total,
               SUM(CASE WHEN k IN (0, 2) THEN 1 ELSE 0 END) > 100 AS over_budget
        FROM ({_CHANGES}) WHERE k <> 1 GROUP BY batch""",
)
def _(t):
    topic = t.user_changes().withColumn("batch", F.to_date("timestamp"))
    return changes.rejected_per_batch(changes.decode(topic, USERS, "batch"), USERS, "batch")


@add(
    "cdc_error_span",
    f"""SELECT user_id % 4 AS "partition", offset_ AS offset,
               count(*) OVER (PARTITION BY user_id % 4 ORDER BY offset_ RANGE BETWEEN 999 PRECEDING AND CURRENT ROW) AS in_span
        FROM ({_CHANGES}) WHERE k IN (0, 2)""",
)
def _(t):
    decoded = changes.decode(t.user_changes(), USERS, "partition", "offset")
    return offsets.count_in_span(decoded.where(changes.is_rejected(USERS)).select("partition", "offset"), 1000)


_SNAPSHOT = """SELECT user_id, age, traffic_source, CAST(NULL AS DOUBLE) AS latitude, created_at, updated_at FROM dim_users"""


def _snapshot(t):
    users = t.users(*_USER_COLUMNS)
    times = {c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at")}
    return users.withColumns({**times, "age": F.col("age").cast("int")})


def _changed(t):
    position = ("partition", "offset")
    usable = changes.decode(t.user_changes(), USERS, *position).where(~changes.is_rejected(USERS))
    return changes.flatten(usable, USERS, *position).select(*_USER_COLUMNS, "is_deleted", *position)


def _merge_sql(condition: str) -> str:
    return f"""
    WITH changes AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY offset_ DESC) AS rn
                     FROM ({_CHANGES}) WHERE k NOT IN (0, 1, 2) AND {condition}),
         snapshot AS ({_SNAPSHOT})
    SELECT {_USER_LIST} FROM snapshot WHERE user_id NOT IN (SELECT user_id FROM changes)
    UNION ALL SELECT {_USER_LIST} FROM changes WHERE rn = 1 AND NOT deletes"""


@add("unique_key_merge", _merge_sql("NOT deletes"))
def _(t):
    upserts = _changed(t).where(F.col("is_deleted") == 0)
    return keyed.merge_changes(_snapshot(t), upserts, ["user_id"], ["partition", "offset"])


@add("unique_key_delete", _merge_sql("TRUE"))
def _(t):
    return keyed.merge_changes(_snapshot(t), _changed(t), ["user_id"], ["partition", "offset"])


@add("stream_user_changes", _merge_sql("TRUE"))
def _(t):
    folder = paths.scratch(t.spark, "change-stream")
    t.user_changes().write.parquet(f"{folder}/topic")
    table = change_streams.keyed_table(t.spark, folder, USERS)
    table.load(_snapshot(t).select(*[F.col(f.name) if f.name in _USER_COLUMNS else F.lit(None).alias(f.name)
                                     for f in USERS.target_schema.fields]))
    lenient = dataclasses.replace(USERS, error_budget=10**12)
    query = change_streams.start_feed(
        read_topic_files(t.spark, f"{folder}/topic"), lenient, table, f"{folder}/dead", f"{folder}/checkpoint",
        availableNow=True,
    )
    query.awaitTermination()
    return table.read().select(*_USER_COLUMNS)


@add(
    "upsert_partial_columns",
    """
    WITH target AS (SELECT order_id, user_id, status, gender, created_at FROM fact_orders WHERE status <> 'Shipped'),
         incoming AS (SELECT l_orderkey AS order_id, MAX(l_linestatus) AS status, MIN(l_shipdate) AS created_at
                      FROM lineitem GROUP BY l_orderkey)
    SELECT COALESCE(t.order_id, i.order_id) AS order_id, t.user_id, COALESCE(i.status, t.status) AS status, t.gender,
           CASE WHEN t.order_id IS NULL THEN i.created_at ELSE t.created_at END AS created_at
    FROM target t FULL JOIN incoming i ON t.order_id = i.order_id""",
)
def _(t):
    target = t.orders("order_id", "user_id", "status", "gender", "created_at").where("status <> 'Shipped'")
    incoming = (
        t.raw("lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.max("l_linestatus").alias("status"), F.min("l_shipdate").alias("created_at"))
    )
    return keyed.upsert(target, incoming, ["order_id"], ["status"])


# -- storage -----------------------------------------------------------------


@add(
    "partition_retention",
    """SELECT event_date, COUNT(*) AS events FROM click_events
       WHERE event_date BETWEEN (SELECT MAX(event_date) FROM click_events) - 7
                            AND (SELECT MAX(event_date) FROM click_events) + 3
       GROUP BY event_date""",
)
def _(t):
    return retained(t.events(), "event_date").groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@add(
    "stream_retention",
    f"""SELECT {_DETAIL} FROM click_messages WHERE verdict = 'valid'
        AND CAST(ts AS DATE) >= (SELECT MAX(CAST(ts AS DATE)) FROM click_messages WHERE verdict = 'valid') - 7""",
)
def _(t):
    folder = paths.scratch(t.spark, "click-stream")
    topic = t.click_topic()
    topic.write.parquet(f"{folder}/topic")
    click_streams.start_valid(
        read_topic_files(t.spark, f"{folder}/topic"), f"{folder}/events", f"{folder}/checkpoint", availableNow=True
    ).awaitTermination()
    newest = read_batches(t.spark, f"{folder}/events", EVENTS).agg(F.max("event_date")).first()[0]
    drop_expired_batches(t.spark, f"{folder}/events", newest or dt.date.min + dt.timedelta(days=7))
    return read_batches(t.spark, f"{folder}/events", EVENTS).select(*_DETAIL_NAMES)


@add("csv_roundtrip", "SELECT id, name, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude FROM dim_centres")
def _(t):
    path = paths.scratch(t.spark, "centres")
    t.centres().write.option("header", "true").csv(path)
    return read_csv(t.spark, path, "distribution_centers").select("id", "name", "latitude", "longitude")


@add(
    "csv_quarantine",
    """SELECT order_id, user_id, status, NULL::VARCHAR AS raw_message FROM fact_orders WHERE order_id % 7 <> 0
       UNION ALL SELECT NULL, NULL, NULL, order_id || ',u' || user_id || ',' || status FROM fact_orders WHERE order_id % 7 = 0""",
)
def _(t):
    # Every seventh order has a word for a user.
    path = paths.scratch(t.spark, "orders-csv")
    user = F.when(F.col("order_id") % 7 == 0, F.concat(F.lit("u"), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    t.orders("order_id", "user_id", "status").withColumn("user_id", user).write.option("header", "true").csv(path)
    good = read_csv(t.spark, path, "orders").select("order_id", "user_id", "status")
    bad = rejected_csv(t.spark, path, "orders").select("raw_message")
    return good.unionByName(bad, allowMissingColumns=True)


@add(
    "clustered_lookup",
    """SELECT event_id, session_id, event_timestamp FROM click_events
       WHERE session_id = (SELECT min(session_id) FROM click_events)
          OR event_timestamp >= (SELECT max(event_timestamp) FROM click_events) - to_hours(6)""",
)
def _(t):
    path = f"{paths.scratch(t.spark, 'clustered')}/events"
    write_clustered(t.events().select("event_id", "session_id", "event_timestamp"), path, ("session_id", "event_timestamp"), 16)
    events = t.spark.read.parquet(path)
    session = events.agg(F.min("session_id")).scalar()
    newest = events.agg(F.max("event_timestamp") - F.expr("INTERVAL 6 HOURS")).scalar()
    return events.where((F.col("session_id") == session) | (F.col("event_timestamp") >= newest))


@add("mv_refresh", "SELECT * FROM session_summary")
def _(t):
    path = paths.scratch(t.spark, "sessions")
    refresh.refresh(clickstream.sessions(t.events(), t.products()), path)
    return refresh.read_current(t.spark, path)


_WINDOW_COLUMNS = """aggregate_id, window_start, window_end, event_date, traffic_source, browser, event_type, page_type,
    total_events, unique_sessions, unique_users, purchase_events, avg_event_lag_seconds"""


@add("mv_refresh_days", f"SELECT {_WINDOW_COLUMNS} FROM window_summary")
def _(t):
    path = f"{paths.scratch(t.spark, 'window-days')}/mart"
    events, build = t.events(), lambda rows: clickstream.window_summary(rows).drop("version_emitted_at")
    # Half of the newest days' events come later; only these days are computed again.
    newest = events.agg(F.max("event_date")).scalar()
    later = (F.col("event_date") > F.date_sub(newest, 5)) & (F.col("event_id") % 2 == 0)
    first = events.where(~F.coalesce(later, F.lit(False)))
    refresh.refresh_days(build, first, first, path)
    refresh.refresh_days(build, events, events.where(later), path)
    return t.spark.read.schema(build(events).schema).parquet(path).select(*_WINDOW_COLUMNS.replace(",", " ").split())


@add(
    "colocated_join",
    """SELECT o.status AS order_status, COUNT(*) AS items, CAST(SUM(i.sale_price) AS DOUBLE) AS revenue
       FROM fact_order_items i LEFT JOIN fact_orders o ON i.order_id = o.order_id GROUP BY o.status""",
)
def _(t):
    path = paths.scratch(t.spark, "orders")
    pair = ColocatedPair(t.spark, path.rsplit("/", 1)[1].replace("-", "_"), path, "order_id")
    orders = t.orders("order_id", "status").withColumnRenamed("status", "order_status")
    pair.write(t.order_items("order_id", "id", "sale_price"), orders)
    return (
        pair.join()
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("items"), F.sum("sale_price").alias("revenue"))
    )


# -- checks ------------------------------------------------------------------

_CHECKED = {
    "dim_products": "dim_products",
    "dim_distribution_centers": "dim_centres",
    "dim_users": "dim_users",
    "fact_inventory_items": "fact_inventory_items",
    "fact_orders": "fact_orders",
    "fact_order_items": "fact_order_items",
    "dwd_clickstream_events": "click_events",
}
#: Columns that the adapters leave empty and that the comparison tables do not have.
_EMPTY = {
    *(("dwd_clickstream_events", column) for column in ("ip_address", "city", "state", "postal_code")),
    *(("dim_users", column) for column in ("street_address", "postal_code")),
}


def _rules_sql() -> str:
    parts = []
    for name, (key, rules) in quality.RULES.items():
        table = _CHECKED[name]
        for rule, test in rules.items():
            parts.append(f"SELECT '{name}' AS table_name, '{rule}' AS rule, COUNT(*) AS violations FROM {table} WHERE NOT ({test})")
        parts.append(f"SELECT '{name}', 'unique_key', COUNT(*) - COUNT(DISTINCT {key}) FROM {table}")
        for column, longest in quality.TEXT_LENGTHS[name].items():
            if (name, column) in _EMPTY:
                parts.append(f"SELECT '{name}', 'length_{column}', CAST(0 AS BIGINT)")
            else:
                long = f"COUNT(*) FILTER (WHERE length({column}) > {longest})"
                parts.append(f"SELECT '{name}', 'length_{column}', {long} FROM {table}")
    return " UNION ALL ".join(parts)


def _tables(t):
    return {
        "dim_products": t.products(),
        "dim_distribution_centers": t.centres(),
        "dim_users": t.users(),
        "fact_inventory_items": t.inventory_items(),
        "fact_orders": t.orders(),
        "fact_order_items": t.order_items("id", "sale_price", "created_at", "status"),
        "dwd_clickstream_events": t.events(),
    }


@add("dq_rules", _rules_sql())
def _(t):
    keys = {
        "dim_users": t.users("user_id"),
        "fact_inventory_items": t.inventory_items("id"),
        "fact_orders": t.orders("order_id"),
        "fact_order_items": t.order_items("id"),
    }
    return quality.check_rules(_tables(t), keys)


@add(
    "dq_foreign_keys",
    " UNION ALL ".join(
        f"""SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table,
                   COUNT(*) AS violations
            FROM {_CHECKED[child]} WHERE {column} IS NOT NULL
             AND {column} NOT IN (SELECT {key} FROM {_CHECKED[parent]})"""
        for child, column, parent, key in quality.FOREIGN_KEYS
    ),
)
def _(t):
    return quality.check_foreign_keys(
        {
            "dim_products": t.products(),
            "dim_distribution_centers": t.centres(),
            "dim_users": t.users("user_id"),
            "fact_inventory_items": t.inventory_items,
            "fact_orders": t.orders,
            "fact_order_items": t.order_items,
            "dwd_clickstream_events": t.events(),
        }
    )
