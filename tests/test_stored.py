"""Stored bitmaps, sketches and days, and plans that read what they need."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from odsflow.operators import bitmaps
from odsflow.plans import analytics, clickstream, sales
from odsflow.sinks import layout, refresh
from odsflow.sources.snapshots import load_csv_folder, read_csv, rejected_csv


def test_merged_bitmaps_count_exactly(spark):
    chance = random.Random(1)
    data = [(chance.choice("abc"), chance.choice([None, 0, -5, 40_000, 1 << 40, chance.randrange(99_999)])) for _ in range(3000)]
    ids = bitmaps.id_bitmaps(spark.createDataFrame(data, "k string, id long"), ["k"], {"n": "id", "again": "id"})
    for keys in (["k"], []):
        found = {tuple(r)[: len(keys)]: (r.n, r.again) for r in bitmaps.distinct_counts(ids, keys, ["n", "again"]).collect()}
        groups = {k[: len(keys)] for k in {(k,) for k, _ in data}}
        for group in groups:
            n = len({i for k, i in data if i is not None and (k,)[: len(keys)] == group})
            assert found[group] == (n, n)
    empty = bitmaps.id_bitmaps(spark.createDataFrame([], "k string, id long"), ["k"], {"n": "id"})
    assert empty.count() == 0 and bitmaps.distinct_counts(empty, [], ["n"]).first().n == 0


def test_bitmaps_are_neither_built_nor_merged_by_sorting(spark):
    rows_of = spark.range(2000).select((F.col("id") % 5).alias("k"), (F.col("id") * 40_000).alias("id"))
    ids = bitmaps.id_bitmaps(rows_of, ["k"], {"n": "id"})
    counts = bitmaps.distinct_counts(ids, ["k"], ["n"])
    assert "SortAggregate" not in plan(counts) and "ObjectHashAggregate" not in plan(counts)
    assert {r.n for r in counts.collect()} == {400}
    assert ids.agg(F.max(F.length(F.col("bits").cast("string")))).first()[0] <= 20


ITEMS = "id long, order_id long, user_id long, product_id long, status string, created_at timestamp, sale_price double"


def test_roll_up_of_stored_hours_needs_no_detail(spark, tmp_path):
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    items = spark.createDataFrame(
        [
            (1, 10, 7, 1, "Shipped", day(1, 9), 5.0), (2, 10, 7, 2, "Returned", day(1, 9), 3.0), (3, 10, 7, 1, "Shipped", day(1, 11), 2.0),
            (4, 11, 8, 1, "Cancelled", day(2, 9), 1.0), (5, 12, 7, 9, "Shipped", day(2, 9), 4.0), (6, None, None, None, None, None, 1.5),
        ],
        ITEMS,
    )
    products = spark.createDataFrame([(1, "a", "x", 1.0), (2, None, None, 2.0)], "product_id long, category string, department string, cost double")
    users = spark.createDataFrame([(7, "FR", "F"), (8, None, "M")], "user_id long, country string, gender string")
    refresh.refresh(sales.hourly_sums(items, products, users), f"{tmp_path}/sums")
    refresh.refresh(sales.hourly_ids(items), f"{tmp_path}/ids")
    stored = [refresh.read_current(spark, f"{tmp_path}/{n}") for n in ("sums", "ids")]
    daily = sales.roll_up(*stored, "day")
    got = {r.period and r.period.day: (r.total_items_ordered, r.total_revenue, r.total_orders, r.total_customers) for r in daily.collect()}
    assert got == {1: (3, 10.0, 1, 1), 2: (2, 5.0, 2, 2), None: (1, 1.5, 0, 0)}
    total = sales.roll_up(*stored, None).first()
    assert (total.total_orders, total.total_customers, total.total_revenue, total.returned_items) == (3, 2, 16.5, 1)
    assert "Expand" not in plan(daily)
    # Groups by several texts: known and unknown keys without a name are one group.
    full = sales.sales_summary(items, products, users)
    assert rows(full.select("product_category", "user_country", "user_gender", "total_items_ordered", "total_orders"))[0] == ("a", "FR", "F", 1, 1)
    assert full.where("product_category IS NULL AND user_gender = 'F'").agg(F.sum("total_items_ordered")).first()[0] == 2
    assert len({tuple(r) for r in full.select("order_hour", "product_category", "product_department", "user_country", "user_gender").collect()}) == full.count()


def events(spark, data):
    schema = "event_id long, event_timestamp timestamp, session_id string, user_id long, event_lag_seconds double"
    labels = {n: F.lit("x") for n in ("traffic_source", "browser", "event_type", "page_type", "uri")}
    made = spark.createDataFrame(data, schema).withColumns(labels).withColumn("product_id", F.lit(None).cast("long"))
    return made.withColumn("event_date", F.col("event_timestamp").cast("date"))


def test_lag_from_stored_hours(spark, tmp_path):
    chance = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    data = [(i, start + dt.timedelta(minutes=chance.randrange(4000)), "s", 1, chance.choice([None, -1.0, 4000.0, chance.expovariate(0.05)])) for i in range(20_000)]
    df = events(spark, data)
    refresh.refresh(analytics.lag_hours(df), f"{tmp_path}/hours")
    hours = refresh.read_current(spark, f"{tmp_path}/hours")
    summary = analytics.lag_summary(hours)
    for off in analytics.rank_errors(summary, df).collect():
        assert max(off.p50_off, off.p95_off, off.p99_off) < analytics.RANK_ERROR
    valid = [(t, lag) for _, t, _, _, lag in data if lag is not None and 0 <= lag < 3600]
    assert {r.period.day: r.sample_size for r in summary.collect()} == {d: sum(t.day == d for t, _ in valid) for d in (1, 2, 3)}
    newest = analytics.newest_lag(hours, 100).first()
    by_hour = sorted({t.replace(minute=0) for t, _ in valid}, reverse=True)
    need, count = 0, 0
    while count < 100:
        count += sum(t.replace(minute=0) == by_hour[need] for t, _ in valid)
        need += 1
    assert newest.sample_size == count
    # The exact figure sorts the newest hours only.
    exact = analytics.recent_lag(df, 100)
    best = sorted(((t, i, lag) for i, t, _, _, lag in data if lag is not None and 0 <= lag < 3600), reverse=True)[:100]
    assert exact.first().max_lag == max(lag for _, _, lag in best)
    assert analytics.recent_lag(df.limit(0)).first().sample_size == 0


def test_first_rows_of_summaries_need_few_events(spark):
    start = dt.datetime(2024, 1, 1)
    df = events(spark, [(i, start + dt.timedelta(minutes=i), f"s{i // 3:04}", 1, 1.0) for i in range(3000)] + [(9000, start, None, 1, 1.0), (9001, None, "s0000", 1, 1.0)])
    kept = analytics.of_first_keys(df, {"session_id": F.col("session_id")}, 50)
    assert kept.count() == 1 + 49 * 3 + 1
    catalogue = spark.createDataFrame([], "product_id long, category string")
    assert rows(analytics.first_sessions(df, catalogue)) == rows(analytics.read_sessions(clickstream.sessions(df, catalogue)))
    timed = df.where("event_timestamp IS NOT NULL")
    assert rows(analytics.first_windows(df)) == rows(analytics.read_windows(clickstream.window_summary(timed)))
    text = plan(analytics.first_sessions(df, catalogue))
    assert "LeftSemi" in text and text.index("LeftSemi") > text.index("HashAggregate")  # below the summary


def test_recent_funnel_is_that_of_all_sessions(spark):
    chance, start = random.Random(3), dt.datetime(2024, 1, 1)
    data = [(i, start + dt.timedelta(minutes=chance.randrange(300)), chance.choice([None, *"abcdefghijklmnopq"]), 1, 1.0) for i in range(60)]
    df = events(spark, data)
    now = F.lit("2024-01-01 05:00:00").cast("timestamp")
    assert analytics.recent_funnel(df, now).collect() == analytics.funnel(clickstream.session_base(df), now).collect()


def files(path, day=None):
    return {f: os.path.getmtime(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and (day is None or f"={day}" in d)}


def test_only_touched_days_are_written_again(spark, tmp_path):
    build = lambda df: df.groupBy("event_date").agg(F.count("*").alias("n"))
    made = lambda *days: spark.createDataFrame([(dt.date(2024, 1, d),) if d else (None,) for d in days], "event_date date")
    path = f"{tmp_path}/mart"
    refresh.refresh_days(build, made(1, 2, 2, 3, 0), made(1, 2, 3, 0), path)
    before = files(path)
    detail = made(1, 2, 2, 2, 4, 0)
    assert refresh.refresh_days(build, detail, made(2, 3, 4), path) == [dt.date(2024, 1, d) for d in (2, 3, 4)]
    assert rows(spark.read.parquet(path).select("event_date", "n")) == rows(build(detail).select("event_date", "n"))
    assert files(path, "2024-01-01").items() <= before.items() and not files(path, "2024-01-02").items() & before.items()
    assert refresh.refresh_days(build, detail, made().limit(0), path) == []


def overlapping(path, column, low, high):
    import pyarrow.parquet as pq

    hit, names = 0, [f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet")]
    for name in names:
        footer = pq.read_metadata(name)
        at = [footer.row_group(0).column(i).path_in_schema for i in range(footer.num_columns)].index(column)
        stats = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
        hit += any(s.max >= high and s.min <= high or low <= s.max and s.min <= high for s in stats)
    return hit, len(names)


def test_clustered_files_are_skipped_by_either_column(spark, tmp_path):
    df = spark.range(20_000).select(
        F.format_string("session-%06d", F.col("id") * 7919 % 20_000).alias("session_id"), F.col("id").alias("tick"),
        F.timestamp_seconds(F.col("id") * 31 % 20_000).alias("event_timestamp"),
    )
    path = f"{tmp_path}/clustered"
    layout.write_clustered(df, path, ("session_id", "event_timestamp"), 64)
    one, total = overlapping(path, "session_id", "session-004321", "session-004321")
    assert total >= 50 and one <= total / 4
    span, _ = overlapping(path, "tick", 0, 0)
    assert span < total
    cells = layout.clustered(df, ("session_id", "event_timestamp"))
    near = cells.where("session_id BETWEEN 'session-004000' AND 'session-004299'").select("cell").distinct().count()
    assert near <= 3 * layout.RANKS  # a few columns of the grid
    assert spark.read.parquet(path).count() == 20_000
    layout.write_clustered(df.limit(0), f"{tmp_path}/empty", ("session_id", "event_timestamp"), 4)
    assert spark.read.parquet(f"{tmp_path}/empty").count() == 0


def scanned(df):
    """Rows that the scan gave out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    leaves = (node.finalPhysicalPlan() if hasattr(node, "finalPhysicalPlan") and "Adaptive" in node.nodeName() else node).collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    df = spark.range(4000).select(
        F.format_string("s%08d", F.col("id") * 2).alias("session_id"), F.col("id").alias("user_id"),
        F.lit(dt.date(2024, 1, 1)).alias("event_date"), F.lit(dt.datetime(2024, 1, 1)).alias("event_timestamp"),
    )
    for name, columns in (("with", layout.BLOOM_COLUMNS), ("without", ())):
        layout.write_daily(df, f"{tmp_path}/{name}", columns)
    absent = "s00000401"  # within the range of every file, but in none
    read = lambda name: spark.read.option("parquet.filter.dictionary.enabled", "false").parquet(f"{tmp_path}/{name}").where(F.col("session_id") == absent)
    assert scanned(read("with")) == 0 and scanned(read("without")) > 0


def test_bad_csv_rows_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "distribution_centers.csv").write_text('name,id,latitude,longitude\nA,1,1.5,2\nB,x,1,2\n"C, D",3,,\nE,4,1\nF,5,1,2,3\n')
    good = read_csv(spark, f"{folder}/distribution_centers.csv", "distribution_centers")
    assert rows(good.select("id", "name")) == [(1, "A"), (3, "C, D")] and good.count() == 2
    bad = rejected_csv(spark, f"{folder}/distribution_centers.csv", "distribution_centers")
    assert sorted(r.raw_message for r in bad.collect()) == ["B,x,1,2", "E,4,1", "F,5,1,2,3"] and bad.count() == 3
    assert dict(load_csv_folder(spark, str(folder), f"{tmp_path}/out")) == {"distribution_centers": f"{tmp_path}/out/distribution_centers"}
    assert spark.read.parquet(f"{tmp_path}/out/rejected/distribution_centers").count() == 3


@pytest.mark.parametrize("missing", ["numpy", "xxhash"])
def test_entry_without_libraries_of_the_training_data_operators(missing):
    import subprocess
    import sys

    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; q = e.queries(); assert 'sessions' in q and set(e.oracle_sql()) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)


def bare_and_carried(spark):
    """Items without and with what their orders say, among them items without an order or with an unknown one."""
    day = lambda d: dt.datetime(2024, 1, d)
    orders = spark.createDataFrame(
        [(10, 7, day(1), "Shipped", 2), (11, 8, day(1), "Complete", 1), (12, None, day(2), "Shipped", 1), (13, 7, day(1), "Shipped", 1)],
        "order_id long, user_id long, created_at timestamp, status string, num_of_item int",
    )
    items = spark.createDataFrame(
        [(1, 10, 1, "Shipped", 5.0), (2, 10, 1, "Returned", 3.0), (3, 11, 2, "Cancelled", None), (4, 12, 9, "Shipped", 4.0),
         (5, 13, 1, None, 1.0), (6, None, 1, "Shipped", 2.0), (7, 99, 1, "Shipped", 2.5), (8, 10, 2, "Shipped", 7.0)],
        "id long, order_id long, product_id long, status string, sale_price double",
    )
    products = spark.createDataFrame([(1, "a", "x", 1.0), (2, "b", "x", 2.0)], "product_id long, category string, department string, cost double")
    users = spark.createDataFrame([(7, "FR", "F"), (8, "FR", "F")], "user_id long, country string, gender string")
    return items, items.join(orders.select("order_id", "user_id", "created_at"), "order_id", "left"), orders, products, users


def test_hourly_sales_of_items_that_get_their_user_from_the_order(spark, no_broadcast):
    bare, carried, orders, products, users = bare_and_carried(spark)
    found = sales.sales_summary(bare, products, users, orders=orders)
    assert "Expand" not in plan(found)
    assert rows(found) == rows(sales.sales_summary(carried, products, users))
    few = (("order_date",), ("total_orders", "total_customers", "net_profit"))
    assert rows(sales.sales_summary(bare, products, users, *few, orders=orders)) == rows(sales.sales_summary(carried, products, users, *few))


def test_flat_sales_of_items_that_get_their_user_from_the_order(spark, no_broadcast):
    bare, carried, orders, products, users = bare_and_carried(spark)
    times = {c: F.lit(None).cast("timestamp") for c in ("shipped_at", "delivered_at", "returned_at")} | {"inventory_item_id": F.col("id")}
    more = {c: F.lit(c) for c in ("name", "brand", "sku")} | {"retail_price": F.lit(3.0), "distribution_center_id": F.lit(1)}
    products = products.withColumns(more)
    users = users.withColumns({c: F.lit(c) for c in ("age", "city", "state", "traffic_source")})
    centres = spark.createDataFrame([(1, "here")], "id int, name string")
    found = sales.sales_flat(bare.withColumns(times), products, users, centres, orders)
    assert rows(found) == rows(sales.sales_flat(carried.withColumns(times), products, users, centres, orders))
