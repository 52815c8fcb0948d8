from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from odsflow.operators import ingest
from odsflow.schemas import CHANGE_FEEDS
from odsflow.sources.snapshots import load_csv_folder, read_csv


def write(folder, name, text):
    (folder / f"{name}.csv").write_text(text)


def test_csv_folder(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    write(folder, "orders", "status,order_id,created_at,num_of_item\nShipped,1,2020-02-29 10:00:00 UTC,2\nComplete,2,oops,\n")
    write(folder, "products", "id,name,retail_price\n5,hat,9.5\n")
    write(folder, "events", "id,session_id,event_type,created_at\n1,s,home,2020-01-01 10:00:00 UTC\n")
    target = str(tmp_path / "out")
    loaded = list(load_csv_folder(spark, str(folder), target, year_shift=1, truncate=True))
    assert [name for name, _ in loaded] == ["products", "orders", "events"]
    orders = spark.read.parquet(f"{target}/orders")
    assert set(orders.columns) == set(CHANGE_FEEDS["orders"].columns)
    text = F.date_format("created_at", "yyyy-MM-dd HH:mm")
    assert rows(orders.select("order_id", "status", text, "num_of_item")) == [
        (1, "Shipped", "2021-02-28 10:00", 2),
        (2, "Complete", None, None),
    ]
    assert spark.read.parquet(f"{target}/products").first().product_id == 5
    assert spark.read.parquet(f"{target}/events").first().created_at.startswith("2021-01-01T10:00:00")
    # Without truncation rows are added; events can be left out.
    again = list(load_csv_folder(spark, str(folder), target, skip_events=True))
    assert [name for name, _ in again] == ["products", "orders"]
    assert spark.read.parquet(f"{target}/orders").count() == 4


def test_csv_types(spark, tmp_path):
    write(tmp_path, "users", "id,age,created_at\n1,30,2020-01-01 00:00:00\n")
    users = read_csv(spark, str(tmp_path / "users.csv"), "users")
    assert dict(users.dtypes)["created_at"] == "timestamp"
    assert dict(users.dtypes)["age"] == "int"


def test_shift_dates(spark):
    df = spark.sql(
        """SELECT '2024-02-29 01:02:03' AS created_at, DATE '2020-01-01' AS order_date, 'no time' AS updated_at,
                  TIMESTAMP '2020-05-05 00:00:00' AS event_timestamp, 'x' AS status"""
    )
    found = ingest.shift_dates(df, 1).select(
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"), F.date_format("order_date", "yyyy-MM-dd"), "updated_at",
        F.date_format("event_timestamp", "yyyy-MM-dd"), "status",
    ).first()
    assert tuple(found) == ("2025-02-28 01:02:03", "2021-01-01", None, "2021-05-05", "x")


def test_normalise_clicks(spark):
    schema = "id string, session_id string, created_at string"
    data = [("1", "a", "t"), ("0", "a", "t"), (None, "a", "t"), ("2", None, "t"), ("3", "", "t"), ("4", "b", None), ("5", "b", "")]
    now = F.lit(dt.datetime(2024, 1, 1))
    found = ingest.normalise_clicks(spark.createDataFrame(data, schema), now)
    assert tuple(ingest.acceptance(found).first()) == (4, 3)
    messages = ingest.to_topic(found).select("key", F.col("value").cast("string"), "topic")
    stamp = "2024-01-01T00:00:00.000000"
    assert rows(messages) == [
        ("a", '{"id":"0","session_id":"a","created_at":"t"}', "clickstream-events"),
        ("a", '{"id":"1","session_id":"a","created_at":"t"}', "clickstream-events"),
        ("b", f'{{"id":"4","session_id":"b","created_at":"{stamp}"}}', "clickstream-events"),
        ("b", f'{{"id":"5","session_id":"b","created_at":"{stamp}"}}', "clickstream-events"),
    ]


def test_normalise_users_sets_both_times_together(spark):
    schema = "id string, created_at string, updated_at string"
    data = [("1", "c", "u"), ("2", None, "u"), ("3", "c", None), ("", "c", "u")]
    now = F.lit(dt.datetime(2024, 1, 1))
    found = ingest.normalise_users(spark.createDataFrame(data, schema), now)
    stamp = "2024-01-01T00:00:00.000000"
    assert rows(found.select("id", "accepted", "created_at", "updated_at")) == [
        ("", False, "c", "u"),
        ("1", True, "c", "u"),
        ("2", True, stamp, stamp),
        ("3", True, "c", None),
    ]


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    for name, text in (("a", "id,name,brand\n1,nameA,brandA\n"), ("b", "id,brand,name\n2,brandB,nameB\n")):
        (tmp_path / "products.csv").mkdir(exist_ok=True)
        (tmp_path / "products.csv" / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "products.csv"), "products").collect()


def test_zero_as_text_is_a_value(spark):
    rows = spark.createDataFrame([(0, "s", None), (1, "0", ""), (2, "", "t"), (None, "s", "t")], "id bigint, session_id string, created_at string")
    assert [r.accepted for r in ingest.normalise_clicks(rows).collect()] == [False, True, False, False]
    text = spark.createDataFrame([("0", "t", "t"), ("", "t", "t"), (None, "t", "t")], "id string, created_at string, updated_at string")
    assert [r.accepted for r in ingest.normalise_users(text).collect()] == [True, False, False]


def test_totals_have_no_ceiling(spark):
    from odsflow.sources.driver import _money

    large = spark.range(40).select(_money(F.lit("9999999999999999.00")).alias("v"))
    assert str(large.agg(F.sum("v")).first()[0]) == "399999999999999960.00"
