from __future__ import annotations

import collections

import pytest
from conftest import DATA, plan, rows
from pyspark.sql import functions as F

from odsflow.functions.times import days_between, in_range, local_hour, recent, whole_units_between
from odsflow.operators.joins import fits_broadcast, scan_bytes
from odsflow.plans import analytics, clickstream, dashboards, quality, trips
from odsflow.registry import QUERIES


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream_", "mv_", "colocated"))])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name].run(spark, DATA))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_date_range_reaches_the_scan(spark, tables):
    text = plan(in_range(tables.orders("order_id", "created_at"), "created_at", "1996-01-01", "1997-01-01"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_recent_rows_are_bounded_in_the_scan(spark, tables):
    found = recent(tables.events(), "event_timestamp", "1 HOUR").select("event_id")
    scan = found._jdf.queryExecution().executedPlan().inputPlan().collectLeaves().apply(0)
    filters = scan.dataFilters().mkString()
    # The bound is a bare subquery in the scan, which Spark turns into a pushed constant.
    assert ">= scalar-subquery" in filters or ">= Subquery" in filters


def test_only_needed_tables_are_joined(spark, tables):
    assert "Join" not in plan(tables.order_items("id", "product_id", "sale_price"))
    assert "Join" not in plan(tables.orders("order_id", "status"))
    assert plan(tables.order_items()).count("Join") >= 1


def test_size_check(spark, tables, no_broadcast):
    assert scan_bytes(tables.products()) > 0
    assert not fits_broadcast(tables.products())
    assert "BroadcastExchange" not in plan(clickstream.sessions(tables.events(), tables.products()))


def test_rows_of_unknown_size_are_not_broadcast(spark):
    unknown = spark.range(5).rdd.map(lambda r: (r[0],)).toDF("k bigint")
    assert not fits_broadcast(unknown)
    assert fits_broadcast(spark.createDataFrame([(1,)], "k bigint")) in (True, False)


# -- a session and a product that hold a third of all rows each --------------


@pytest.fixture(scope="module")
def hot(spark):
    n = F.col("id")
    events = spark.range(9000).select(
        n.alias("event_id"),
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), n % 700)).alias("session_id"),
        (n % 11).alias("user_id"),
        F.when(n % 2 == 0, "Email").otherwise("Organic").alias("traffic_source"),
        F.when(n % 7 == 0, None).otherwise(F.concat(F.lit("b"), n % 3)).alias("browser"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=n.cast("decimal(18,6)"))).alias("event_timestamp"),
        F.element_at(F.array(*[F.lit(v) for v in ("product", "cart", "purchase", "home")]), (n % 4 + 1).cast("int")).alias("event_type"),
        F.element_at(F.array(*[F.lit(v) for v in ("product", "cart", "purchase", "home")]), (n % 4 + 1).cast("int")).alias("page_type"),
        F.when(n % 4 == 0, F.when(n % 3 == 0, 1).otherwise(n % 40)).alias("product_id"),
    )
    products = spark.range(30).select(
        n.alias("product_id"), F.when(n % 10 != 9, F.concat(F.lit("c"), n % 5)).alias("category")
    )
    return events, products


def by_hand(events, products):
    category = {r.product_id: r.category for r in products.collect()}
    out = {}
    for session, group in _grouped(events.collect(), "session_id").items():
        counts = collections.Counter(category.get(e.product_id) for e in group)
        counts.pop(None, None)
        top = min(counts, key=lambda c: (-counts[c], c)) if counts else None
        browsers = [e.browser for e in group if e.browser is not None]
        times = [e.event_timestamp for e in group]
        out[session] = (
            min(e.user_id for e in group), min(e.traffic_source for e in group), min(browsers) if browsers else None,
            int((max(times) - min(times)).total_seconds()), len(group),
            sum(e.page_type == "product" for e in group), sum(e.event_type == "purchase" for e in group),
            any(e.page_type == "home" for e in group), any(e.event_type == "cart" for e in group), top,
        )
    return out


def _grouped(items, name):
    groups = collections.defaultdict(list)
    for item in items:
        groups[item[name]].append(item)
    return groups


def check_sessions(hot):
    found = clickstream.sessions(*hot).select(
        "session_id", "user_id", "traffic_source", "browser", "session_duration_seconds", "event_count",
        "product_view_count", "purchase_count", "saw_home", "added_to_cart", "top_category",
    )
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == by_hand(*hot)


def test_hot_session(hot):
    check_sessions(hot)


def test_hot_session_with_a_large_catalogue(hot, no_broadcast):
    check_sessions(hot)


def test_sessions_read_events_once(spark, tables):
    text = plan(clickstream.sessions(tables.events(), tables.products()))
    assert text.count("events.parquet") == 1
    # Session and category, then session: the two last steps share one shuffle.
    assert text.count("Exchange hashpartitioning") == 2


def test_base_and_top_category_agree_with_the_whole(hot):
    whole = clickstream.sessions(*hot)
    base = clickstream.session_base(hot[0])
    assert rows(whole.select(*base.columns)) == rows(base)
    top = clickstream.session_top_category(*hot)
    assert rows(whole.where("top_category IS NOT NULL").select("session_id", "top_category")) == rows(top)


# -- parameters --------------------------------------------------------------


def test_funnel_over_given_sessions(spark):
    made = spark.sql(
        """SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01 10:00:00', true, true, false),
                                ('b', TIMESTAMP '2024-01-01 10:30:00', true, false, false),
                                ('c', TIMESTAMP '2024-01-01 08:00:00', true, true, true)
           AS t(session_id, session_start, saw_product, added_to_cart, purchased)"""
    )
    found = analytics.funnel(made, "2024-01-01 10:45:00").first()
    assert tuple(found) == (2, 2, 1, 0, 100.0, 50.0, 0.0)
    # Nothing in the hour: no division by zero.
    assert analytics.funnel(made, "2025-01-01 00:00:00").first().view_rate_pct is None


def test_dashboard_range_is_half_open(spark):
    sales = spark.sql(
        """SELECT TIMESTAMP '2024-01-01 00:00:00' AS order_item_created_at, 1.5D AS sale_price
           UNION ALL SELECT TIMESTAMP '2024-02-01 00:00:00', 4D"""
    )
    assert dashboards.gross_revenue(sales, dashboards.Range("2024-01-01", "2024-02-01")).first()[0] == 1.5
    assert dashboards.gross_revenue(sales, dashboards.Range("2024-01-02")).first()[0] == 4.0
    assert dashboards.gross_revenue(sales, dashboards.Range()).first()[0] == 5.5


def test_sales_charts_on_the_flat_mart(spark):
    sales = spark.sql(
        """SELECT * FROM VALUES (TIMESTAMP '2024-01-01', 1, 10, 5D, 2D, 'F', 'Shipped'),
                                (TIMESTAMP '2024-01-01', 1, 10, 7D, 3D, 'M', 'Returned'),
                                (TIMESTAMP '2024-01-02', 2, 11, 1D, 1D, 'F', 'Shipped')
           AS t(order_item_created_at, order_id, user_id, sale_price, product_profit, user_gender, order_item_status)"""
    )
    every = dashboards.Range()
    assert dashboards.order_count(sales, every).first()[0] == 2
    assert dashboards.net_profit(sales, every).first()[0] == 6.0
    assert dashboards.customer_count(sales, every).first()[0] == 2
    assert dashboards.average_order_value(sales, every).first()[0] == 6.5
    assert rows(dashboards.items_by_status(sales, every)) == [("Returned", 1), ("Shipped", 2)]
    assert rows(dashboards.revenue_by_gender(sales, every)) == [("F", 6.0), ("M", 7.0)]


def test_trip_filters(spark, tables):
    made = tables.trips()
    every = made.count()
    assert trips.choose(made).count() == every
    some = trips.choose(made, ["1", "2"], "1996-01-01", "1997-01-01")
    expected = made.where("route_no IN ('1', '2') AND date >= '1996-01-01' AND date < '1997-01-01'")
    assert 0 < some.count() == expected.count() < every


def test_trip_without_duration_has_no_speed(spark):
    made = spark.sql("SELECT 0D AS trip_duration_minutes, 5D AS total_distance_km, TIMESTAMP '2024-01-01 20:00:00' AS start_time")
    found = trips.trip_columns(made).first()
    assert (found.avg_speed, found.hour_vn) == (0.0, 3)


def test_time_functions(spark):
    row = spark.sql(
        "SELECT TIMESTAMP '2024-01-01 23:50:00' AS a, TIMESTAMP '2024-01-02 00:10:00' AS b"
    ).select(days_between("a", "b"), whole_units_between("DAY", "a", "b"), local_hour("a", "Asia/Ho_Chi_Minh"))
    assert tuple(row.first()) == (1, 0, 6)


def test_broken_rules_are_counted(spark):
    products = spark.sql(
        """SELECT * FROM VALUES (1L, -1D, 5D, 'c', 'n', 'b', 'd', 's', 1L), (1L, 1D, NULL, repeat('x', 101), 'n', 'b', 'd', 's', 1L),
                                (NULL, 1D, 1D, 'c', 'n', 'b', 'd', 's', 1L)
           AS t(product_id, cost, retail_price, category, name, brand, department, sku, distribution_center_id)"""
    )
    found = {r.rule: r.violations for r in quality.check_rules({"dim_products": products}).collect()}
    # A comparison with null passes; a repeated key and a missing one each count once.
    assert found["prices_not_negative"] == 1
    assert found["unique_key"] == 2
    assert found["length_category"] == 1
    assert found["length_name"] == 0


def test_throughput_of_a_steady_stream(spark):
    steady = spark.range(3600).select(F.timestamp_seconds("id").alias("event_timestamp"))
    found = analytics.throughput(steady, "10 minutes").first()
    assert tuple(found) == (6, 1.0, 0.0, True)
    uneven = steady.where("minute(event_timestamp) < 10 OR second(event_timestamp) = 0")
    assert analytics.throughput(uneven, "10 minutes").first().is_stable is False


# -- hot keys in a join that cannot be broadcast ------------------------------


@pytest.mark.parametrize("hot_key", ["7", "NULL"])
def test_hot_join_key_is_split(spark, no_broadcast, hot_key):
    """A key, or the lack of one, that a third of the rows share is spread over tasks."""
    from odsflow.operators.joins import lookup_join

    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        fact = spark.range(0, 60000, 1, 8).select(
            F.expr(f"CASE WHEN id % 3 = 0 THEN {hot_key} ELSE id % 900 END").cast("bigint").alias("k"),
            F.col("id").alias("row"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        dim = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("double"))
        joined = lookup_join(fact, dim, "k").select("row", "double")
        found = joined.collect()
        assert "skew=true" in plan(joined)  # the final plan, after adaptive execution
        expected = {n: (None if hot_key == "NULL" else 14) if n % 3 == 0 else n % 900 * 2 for n in range(60000)}
        assert {r.row: r.double for r in found} == expected
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)



def test_charts_on_stored_marts_read_their_range_only(spark, tables, tmp_path):
    within = dashboards.Range("2024-01-05", "2024-01-08")
    whole = clickstream.sessions(tables.events(), tables.products())
    whole.write.partitionBy("session_date").parquet(f"{tmp_path}/sessions")
    mart = spark.read.parquet(f"{tmp_path}/sessions")
    pairs = [
        (dashboards.session_figures(None, within, mart), dashboards.session_figures(tables.events(), within)),
        (dashboards.sessions_by(None, within, "browser", 20, mart), dashboards.sessions_by(tables.events(), within, "browser", 20)),
        (
            dashboards.funnel_by_category(None, None, within, mart),
            dashboards.funnel_by_category(tables.events(), tables.products(), within),
        ),
    ]
    for stored, computed in pairs:
        assert "session_date" in plan(stored).split("PartitionFilters: ")[1].split("]")[0]
        assert rows(stored) == rows(computed)


def test_raw_events_are_not_sorted(spark, tables):
    text = plan(clickstream.session_base(tables.events()))
    below = text[text.rindex("Exchange") :]
    assert "SortAggregate" not in below and "HashAggregate" in below


def test_keys_are_checked_without_joins(spark, tables):
    found = quality._key_rule("fact_order_items", tables.order_items("id"))
    assert "Join" not in plan(found) and "Expand" not in plan(found)
