from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from odsflow.operators.selection import listed_columns, retained, select_rows
from odsflow.sinks import paths, refresh
from odsflow.sinks.layout import ColocatedPair, drop_expired_days, hot_keys, write_daily


def test_refresh_shows_the_last_complete_version(spark, tmp_path):
    path = f"{tmp_path}/mart"
    with pytest.raises(FileNotFoundError):
        refresh.read_current(spark, path)
    assert refresh.refresh(spark.range(3), path) == 0
    assert refresh.refresh(spark.range(5), path) == 1
    # A version that was never committed is not seen, nor is its number taken again.
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/version=2")
    assert refresh.read_current(spark, path).count() == 5
    assert refresh.refresh(refresh.read_current(spark, path).limit(4), path) == 3
    assert refresh.read_current(spark, path).count() == 4
    refresh.drop_old_versions(spark, path, keep=1)
    assert paths.numbered(spark, path, "version") == [3]


def days(spark):
    return spark.range(1000).select(
        F.concat(F.lit("s"), F.col("id") % 50).alias("session_id"),
        (F.col("id") % 40).alias("user_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=(F.col("id") % 240).cast("int"))).alias(
            "event_timestamp"
        ),
    ).withColumn("event_date", F.to_date("event_timestamp"))


def test_daily_layout(spark, tmp_path):
    path = f"{tmp_path}/events"
    write_daily(days(spark), path)
    assert paths.numbered_dates(spark, path, "event_date")[0] == dt.date(2024, 1, 1)
    stored = spark.read.parquet(path)
    assert stored.count() == 1000
    day = stored.where("event_date = DATE '2024-01-03'")
    assert "PartitionFilters: [isnotnull(event_date" in plan(day)
    import pyarrow.parquet as pq

    file = glob.glob(f"{path}/event_date=2024-01-03/*.parquet")[0]
    times = pq.read_table(file, columns=["event_timestamp"])["event_timestamp"].to_pylist()
    assert times == sorted(times)


def test_bloom_filters_are_written(spark, tmp_path):
    # Only columns that outgrow their dictionary get a filter, so the ids are long and all different.
    ids = spark.range(40000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("session_id"),
        F.col("id").alias("user_id"),
        F.lit("2024-01-01").cast("timestamp").alias("event_timestamp"),
        F.lit("2024-01-01").cast("date").alias("event_date"),
    )
    sizes = []
    for columns in ((), ("session_id", "user_id")):
        path = f"{tmp_path}/bloom{len(columns)}"
        write_daily(ids, path, bloom_columns=columns)
        sizes.append(sum(os.path.getsize(f) for f in glob.glob(f"{path}/*/*.parquet")))
    assert sizes[1] > sizes[0]


def test_expired_days(spark, tmp_path):
    path = f"{tmp_path}/events"
    write_daily(days(spark), path)
    dropped = drop_expired_days(spark, path, dt.date(2024, 1, 10))
    assert dropped == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert spark.read.parquet(path).agg(F.min("event_date")).first()[0] == dt.date(2024, 1, 3)


def test_retained(spark):
    found = retained(days(spark), "event_date").agg(F.min("event_date"), F.max("event_date")).first()
    assert tuple(found) == (dt.date(2024, 1, 3), dt.date(2024, 1, 10))
    found = retained(days(spark), "event_date", "2024-01-05").agg(F.max("event_date")).first()
    assert found[0] == dt.date(2024, 1, 8)


def test_hot_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in hot_keys(df, "k").collect()] == [-1]


@pytest.fixture
def skewed(spark, tmp_path):
    """Items of which a third belong to one order and some to none."""
    items = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 != 1, F.col("id") % 500).alias("order_id"),
        F.col("id").alias("item"),
    )
    orders = spark.range(450).select(F.col("id").alias("order_id"), (F.col("id") * 2).alias("total"))
    pair = ColocatedPair(spark, f"pair_{abs(hash(str(tmp_path)))}", f"{tmp_path}/pair", "order_id")
    pair.write(items, orders)
    yield items, orders, pair
    pair.drop()


def test_colocated_join_moves_no_rows(spark, skewed, no_broadcast):
    _, _, pair = skewed
    text = plan(pair.bucketed_join())
    assert "SortMergeJoin" in text and "Exchange" not in text


@pytest.mark.parametrize("how", ["left", "inner"])
def test_colocated_join_is_whole(spark, skewed, how):
    items, orders, pair = skewed
    names = ["order_id", "item", "total"]
    assert rows(pair.join(how).select(names)) == rows(items.join(orders, "order_id", how).select(names))


def test_hot_rows_are_kept_out_of_the_buckets(spark, skewed):
    _, _, pair = skewed
    bucketed = spark.table(f"{pair.name}_child")
    assert bucketed.where("order_id = 7 OR order_id IS NULL").count() == 0


def test_select_rows(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("odd"))
    found = select_rows(df, ["id"], "odd = 1", [F.desc("id")], 2)
    assert [r.id for r in found.collect()] == [9, 7]
    assert "TakeOrderedAndProject" in plan(found)
    assert select_rows(df).count() == 10
    assert listed_columns(df, ["odd", "missing", "id"]).columns == ["odd", "id"]
