from __future__ import annotations

import datetime as dt
import json
import shutil
import time

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from odsflow.operators import clicks
from odsflow.schemas import BAD_JSON, CHANGE_FEEDS, DEAD_LETTERS, EVENTS, TOPIC_ROW
from odsflow.sinks.append import append_batch, read_batches
from odsflow.sinks.layout import drop_expired_batches
from odsflow.sources.topics import read_topic_files
from odsflow.streaming import changes as change_streams
from odsflow.streaming import clicks as click_streams


def click(key, time, kind="home", **extra):
    body = {"id": key, "session_id": "s", "event_type": kind, "created_at": f"2024-01-01T{time}:00", **extra}
    return json.dumps(body)


def put(spark, path, texts, offset=0):
    """Add one file to a topic folder."""
    data = [
        ("s", None if t is None else bytearray(t.encode()), "clickstream-events", 0, offset + i, dt.datetime(2024, 1, 1))
        for i, t in enumerate(texts)
    ]
    spark.createDataFrame(data, TOPIC_ROW).coalesce(1).write.mode("append").parquet(path)


def run_valid(spark, tmp_path, **options):
    """One run over what is new in the topic, one file per batch."""
    query = click_streams.start_valid(
        read_topic_files(spark, f"{tmp_path}/topic", 1),
        f"{tmp_path}/events",
        f"{tmp_path}/checkpoint",
        availableNow=True,
        **options,
    )
    query.awaitTermination()
    return query


def ids(spark, tmp_path):
    return sorted(r.event_id for r in read_batches(spark, f"{tmp_path}/events", EVENTS).collect())


def test_duplicates_and_late_rows(spark, tmp_path):
    put(spark, f"{tmp_path}/topic", [click(1, "10:00"), click(1, "10:00"), click(2, "10:20"), None, "junk"])
    run_valid(spark, tmp_path)
    assert ids(spark, tmp_path) == [1, 2]
    late = [click(2, "10:20"), click(3, "10:15"), click(4, "10:05"), click(1, "10:00")]
    put(spark, f"{tmp_path}/topic", late, 5)
    counted = click_streams.count_late(spark)
    query = run_valid(spark, tmp_path)
    assert ids(spark, tmp_path) == [1, 2, 3]
    while str(query.runId) not in counted.ended:  # reports come a little later
        time.sleep(0.1)
    spark.streams.removeListener(counted)
    assert counted.dropped[str(query.id)] == 2


def test_run_without_new_messages(spark, tmp_path):
    put(spark, f"{tmp_path}/topic", [click(1, "10:00")])
    run_valid(spark, tmp_path)
    run_valid(spark, tmp_path)
    assert ids(spark, tmp_path) == [1]


def test_empty_table_can_be_read(spark, tmp_path):
    assert read_batches(spark, f"{tmp_path}/nothing", EVENTS).count() == 0


def test_replayed_batch_is_not_doubled(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "event_id bigint, day string")
    events = df.select("event_id", F.col("day").cast("date").alias("event_date"))
    path = f"{tmp_path}/events"
    for batch in (0, 1, 1):
        append_batch(events, path, batch, ["event_id", "event_date", "no_such_column"], ["event_date"])
    append_batch(events.where("event_id = 1"), path, 1, ["event_id", "event_date"], ["event_date"])
    read = spark.read.parquet(path)
    assert rows(read.select("batch_id", "event_id")) == [(0, 1), (0, 2), (1, 1)]


def test_dead_letters(spark, tmp_path):
    put(spark, f"{tmp_path}/topic", [click(1, "10:00"), "junk", None, "{}"])
    click_streams.start_dead_letters(
        read_topic_files(spark, f"{tmp_path}/topic"), f"{tmp_path}/dead", f"{tmp_path}/checkpoint", availableNow=True
    ).awaitTermination()
    found = read_batches(spark, f"{tmp_path}/dead", DEAD_LETTERS)
    assert found.count() == 2
    assert found.where(F.col("raw_message") == "junk").first().error_message == BAD_JSON


def test_stream_equals_batch(spark, tables, tmp_path):
    topic = tables.click_topic()
    topic.repartition(3).write.parquet(f"{tmp_path}/topic")
    click_streams.start_valid(
        read_topic_files(spark, f"{tmp_path}/topic"), f"{tmp_path}/events", f"{tmp_path}/checkpoint", availableNow=True
    ).awaitTermination()
    names = ["event_id", "event_timestamp", "session_id", "page_type", "product_id", "event_date"]
    batch = clicks.enrich(clicks.deduplicate(clicks.valid(clicks.parse(topic)))).select(*names)
    assert rows(read_batches(spark, f"{tmp_path}/events", EVENTS).select(*names)) == rows(batch)


def test_products_are_those_of_the_time_of_the_batch(spark, tmp_path):
    topic = lambda n, text: dt.datetime(2024, 1, 1, 0, 0, n)
    feed = CHANGE_FEEDS["products"]
    table = change_streams.keyed_table(spark, str(tmp_path), feed)

    def change(batch, category):
        body = json.dumps({"op": "c", "before": None, "after": {"id": 5, "category": category}})
        row = [(None, bytearray(body.encode()), feed.topic, 0, batch, topic(batch, body))]
        change_streams.apply_batch(spark.createDataFrame(row, TOPIC_ROW), batch, feed, table, f"{tmp_path}/dead")

    change(0, "Hats")
    put(spark, f"{tmp_path}/topic", [click(1, "10:00", "product", uri="/product/5"), click(2, "10:01")])
    run_valid(spark, tmp_path, products=table.read)
    change(1, "Caps")
    table.fold()
    table.drop_folded()
    put(spark, f"{tmp_path}/topic", [click(3, "10:02", "product", uri="/product/5")], 2)
    run_valid(spark, tmp_path, products=table.read)
    found = spark.read.parquet(f"{tmp_path}/events").select("event_id", "product_category")
    assert rows(found) == [(1, "Hats"), (2, None), (3, "Caps")]


def test_another_checkpoint_is_refused(spark, tmp_path):
    put(spark, f"{tmp_path}/topic", [click(1, "10:00")])
    run_valid(spark, tmp_path)
    shutil.rmtree(f"{tmp_path}/checkpoint")
    with pytest.raises(StreamingQueryException, match="belongs to stream"):
        run_valid(spark, tmp_path)
    assert ids(spark, tmp_path) == [1]


def test_retention_of_the_event_table(spark, tmp_path):
    for day, key in enumerate((1, 2, 3, 4)):
        body = json.dumps({"id": key, "session_id": "s", "event_type": "home", "created_at": f"2024-01-{10 + day}T10:00:00"})
        put(spark, f"{tmp_path}/topic", [body], key)
        run_valid(spark, tmp_path)
    gone = drop_expired_batches(spark, f"{tmp_path}/events", dt.date(2024, 1, 20))
    assert gone == [dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 1, 12)]
    assert ids(spark, tmp_path) == [4]
    run_valid(spark, tmp_path)
    assert ids(spark, tmp_path) == [4]


def window_totals(spark, tmp_path):
    found = spark.read.option("basePath", f"{tmp_path}/counts").parquet(f"{tmp_path}/counts/batch_id=*")
    return rows(found.select(F.date_format("window_start", "HH:mm"), "total_events"))


def run_windows(spark, tmp_path):
    click_streams.start_window_counts(
        read_topic_files(spark, f"{tmp_path}/topic", 1), f"{tmp_path}/counts", f"{tmp_path}/checkpoint", availableNow=True
    ).awaitTermination()


def test_repeated_messages_count_once_in_windows(spark, tmp_path):
    put(spark, f"{tmp_path}/topic", [click(1, "10:00"), click(1, "10:00"), click(2, "10:04"), click(3, "10:05")])
    run_windows(spark, tmp_path)
    assert window_totals(spark, tmp_path) == []
    # Repeats in a later batch, then a message that moves the watermark past both windows.
    put(spark, f"{tmp_path}/topic", [click(1, "10:00"), click(3, "10:05"), click(4, "10:04")], 4)
    run_windows(spark, tmp_path)
    put(spark, f"{tmp_path}/topic", [click(5, "10:30"), "junk"], 7)
    run_windows(spark, tmp_path)
    assert window_totals(spark, tmp_path) == [("10:00", 3), ("10:05", 1)]


def test_late_rows_are_kept(spark, tmp_path):
    def run():
        click_streams.start_late_rows(
            read_topic_files(spark, f"{tmp_path}/topic", 1), f"{tmp_path}/late", f"{tmp_path}/checkpoint", availableNow=True
        ).awaitTermination()
        run_valid(spark, tmp_path)

    put(spark, f"{tmp_path}/topic", [click(1, "10:00"), click(2, "10:20"), "junk"])
    run()
    put(spark, f"{tmp_path}/topic", [click(3, "10:15"), click(4, "10:05"), click(1, "10:00"), click(5, "10:10")], 3)
    run()
    late = click_streams.late_rows(spark, f"{tmp_path}/late")
    assert sorted(r.id for r in late.collect()) == [1, 4, 5] and {r.error_message for r in late.collect()} == {"older than the watermark"}
    # The copy of a message that was in time is no loss.
    events = read_batches(spark, f"{tmp_path}/events", EVENTS)
    assert sorted(r.id for r in click_streams.late_rows(spark, f"{tmp_path}/late", events).collect()) == [4, 5]
    run()
    assert late.count() == 3


def test_a_missing_offset_stops_the_batch(spark, tmp_path):
    def run():
        click_streams.start_offsets(
            read_topic_files(spark, f"{tmp_path}/topic", 1), f"{tmp_path}/offsets", f"{tmp_path}/checkpoint", availableNow=True
        ).awaitTermination()

    put(spark, f"{tmp_path}/topic", ["a", "b", "c"])
    run()
    put(spark, f"{tmp_path}/topic", ["c", "d"], 2)  # delivered again
    run()
    put(spark, f"{tmp_path}/topic", ["f"], 5)
    with pytest.raises(StreamingQueryException, match="clickstream-events/0: 4 to 4"):
        run()
    with pytest.raises(StreamingQueryException, match="4 to 4"):
        run()


def test_window_counts(spark, tmp_path):
    path = f"{tmp_path}/rows"
    schema = "event_id bigint, event_timestamp timestamp, session_id string, user_id bigint"
    labels = {n: F.lit("x") for n in ("traffic_source", "browser", "event_type", "page_type")}

    def put_rows(*times):
        data = [(i, dt.datetime(2024, 1, 1, *t), "s", 1) for i, t in enumerate(times)]
        spark.createDataFrame(data, schema).withColumns(labels).coalesce(1).write.mode("append").parquet(path)

    def run():
        stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        query = (
            click_streams.window_counts(stream.withWatermark("event_timestamp", clicks.WATERMARK))
            .writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").select(F.date_format("window_start", "HH:mm"), "total_events")

    put_rows((10, 0), (10, 4), (10, 5))
    assert run().count() == 0
    put_rows((10, 30))
    assert rows(run()) == [("10:00", 2), ("10:05", 1)]


def test_change_stream(spark, tmp_path):
    feed = CHANGE_FEEDS["distribution_centers"]
    body = [
        json.dumps({"payload": {"before": None, "after": {"id": 1, "name": "A"}, "op": "c"}}),
        json.dumps({"before": {"id": 1}, "after": {"id": 1, "name": "B"}, "op": "u"}),
        json.dumps({"before": None, "after": {"id": 2, "name": "C"}, "op": "c"}),
        json.dumps({"before": {"id": 2}, "after": None, "op": "d"}),
        None,
    ]
    table = change_streams.keyed_table(spark, str(tmp_path), feed)

    def run():
        change_streams.start_feed(
            read_topic_files(spark, f"{tmp_path}/topic", 1),
            feed, table, f"{tmp_path}/dead", f"{tmp_path}/checkpoint", availableNow=True,
        ).awaitTermination()
        return rows(table.read().select("id", "name"))

    put(spark, f"{tmp_path}/topic", body[:3])
    assert run() == [(1, "B"), (2, "C")]
    put(spark, f"{tmp_path}/topic", body[3:], 3)
    assert run() == [(1, "B")]


def test_all_feeds_start(spark, tmp_path):
    def read(session, _, topic, __):
        session.createDataFrame([], TOPIC_ROW).write.mode("overwrite").parquet(f"{tmp_path}/{topic}")
        return read_topic_files(session, f"{tmp_path}/{topic}")

    started = change_streams.start_all(spark, "", f"{tmp_path}/t", f"{tmp_path}/c", read, availableNow=True)
    for query in started.values():
        query.awaitTermination()
    assert sorted(started) == sorted(feed.table for feed in CHANGE_FEEDS.values())


def test_runner_on_archived_topics(spark, tmp_path):
    from odsflow.streaming.__main__ import parse, start

    archive = f"{tmp_path}/archive"
    put(spark, f"{archive}/clickstream-events", [click(1, "10:00"), "junk"])
    put(spark, f"{archive}/clickstream-events", [click(2, "10:30")], 2)
    for feed in CHANGE_FEEDS.values():
        put(spark, f"{archive}/{feed.topic}", [json.dumps({"after": {feed.key: 5}, "op": "c"})])
    for stream in ("clicks", "changes"):
        arguments = [stream, "--root", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/cp", "--archive", archive, "--once", "--contiguous", "--windows"]
        for query in start(spark, parse(arguments)):
            query.awaitTermination()
    assert read_batches(spark, f"{tmp_path}/out/dwd_clickstream_events", EVENTS).count() == 2
    put(spark, f"{archive}/clickstream-events", [click(3, "09:00")], 3)
    for query in start(spark, parse(["clicks", *arguments[1:]])):
        query.awaitTermination()
    events = read_batches(spark, f"{tmp_path}/out/dwd_clickstream_events", EVENTS)
    late = click_streams.late_rows(spark, f"{tmp_path}/out/clickstream_late_rows", events)
    assert events.count() == 2 and [r.id for r in late.collect()] == [3]
    assert read_batches(spark, f"{tmp_path}/out/ods_clickstream_deadletter", DEAD_LETTERS).count() == 1
    for feed in CHANGE_FEEDS.values():
        table = change_streams.keyed_table(spark, f"{tmp_path}/out", feed)
        assert [row[feed.target_key] for row in table.read().collect()] == [5]
