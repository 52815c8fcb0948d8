from __future__ import annotations

import dataclasses
import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from conftest import rows
from pyspark.sql import functions as F

from odsflow.operators import changes, keyed, offsets
from odsflow.schemas import CHANGE_FEEDS
from odsflow.sinks.append import read_batches
from odsflow.sinks.paths import numbered
from odsflow.sources.topics import read_topic_files
from odsflow.streaming import changes as change_streams
from odsflow.streaming.clicks import LostMessages
from odsflow.streaming.changes import ErrorBudgetExceeded, apply_batch, keyed_table

CENTRES, ITEMS = CHANGE_FEEDS["distribution_centers"], CHANGE_FEEDS["order_items"]


def message(op, before=None, after=None, wrapped=True):
    body = {"before": before, "after": after, "op": op, "ts_ms": 1}
    return json.dumps({"payload": body} if wrapped else body)


def topic(spark, messages, first=1):
    data = [
        (None, None if m is None else bytearray(m.encode()), "t", 0, first + i, dt.datetime(2024, 1, 1))
        for i, m in enumerate(messages)
    ]
    schema = "key string, value binary, topic string, partition int, offset bigint, timestamp timestamp"
    return spark.createDataFrame(data, schema)


def centre(key, name):
    return {"id": key, "name": name}


#: Snapshot read, insert, update, delete by key, tombstone, re-insert, delete of an unknown key.
LOG = [
    message("r", None, centre(7, "A")),
    message("c", None, centre(8, "B"), wrapped=False),
    message("u", centre(7, "A"), centre(7, "A2")),
    message("d", {"id": 8}, None, wrapped=False),
    None,
    message("c", None, centre(8, "B3")),
    message("d", {"id": 9}, None),
]
STATES = [
    [(7, "A")],
    [(7, "A"), (8, "B")],
    [(7, "A2"), (8, "B")],
    [(7, "A2")],
    [(7, "A2")],
    [(7, "A2"), (8, "B3")],
    [(7, "A2"), (8, "B3")],
]


def state(table):
    return rows(table.read().select("id", "name"))


def apply(spark, table, texts, batch_id, first, tmp_path, feed=CENTRES):
    apply_batch(topic(spark, texts, first), batch_id, feed, table, str(tmp_path / "dead"))


def test_state_after_every_batch(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path), CENTRES)
    assert state(table) == []
    for n, (text, expected) in enumerate(zip(LOG, STATES)):
        apply(spark, table, [text], n, n + 1, tmp_path)
        assert state(table) == expected


@pytest.mark.parametrize("cuts", [(), (3,), (1, 4), (2, 3, 5)])
def test_batching_and_folding_do_not_matter(spark, tmp_path, cuts):
    table = keyed_table(spark, str(tmp_path), CENTRES)
    bounds = [0, *cuts, len(LOG)]
    for n, (start, end) in enumerate(itertools.pairwise(bounds)):
        apply(spark, table, LOG[start:end], n, start + 1, tmp_path)
        apply(spark, table, LOG[start:end], n, start + 1, tmp_path)  # replayed
        if n % 2 == 0:
            table.fold()
            apply(spark, table, LOG[start:end], n, start + 1, tmp_path)  # replayed after it was folded
    assert state(table) == STATES[-1]
    table.fold()
    table.drop_folded()
    assert state(table) == STATES[-1]
    assert numbered(spark, f"{tmp_path}/{CENTRES.table}/log", "batch_id") == []


def test_snapshots(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path), CENTRES)
    schema = "id bigint, name string, latitude double, longitude double"
    table.load(spark.createDataFrame([(n, "old", None, None) for n in (3, 15, 27, 28)], schema))
    with pytest.raises(ValueError):
        table.load(spark.createDataFrame([], schema))
    log = [message("u", None, centre(28, "new")), message("d", {"id": 15}), message("c", None, centre(-4, "low"))]
    apply(spark, table, log, 0, 1, tmp_path)
    expected = [(-4, "low"), (27, "old"), (28, "new"), (3, "old")]
    assert state(table) == expected
    assert table.fold() == 0
    assert table.fold() is None
    assert state(table) == expected
    table.drop_folded()
    assert state(table) == expected
    assert numbered(spark, f"{tmp_path}/{CENTRES.table}/snapshot", "upto") == [0]
    # The deleted key comes back.
    apply(spark, table, [message("c", None, centre(15, "again"))], 1, 4, tmp_path)
    table.fold()
    table.drop_folded()
    assert state(table) == sorted([*expected, (15, "again")], key=str)


def test_a_batch_that_arrives_while_folding_is_kept(spark, tmp_path, monkeypatch):
    table = keyed_table(spark, str(tmp_path), CENTRES)
    apply(spark, table, [message("c", None, centre(1, "10"))], 0, 1, tmp_path)
    write = type(table)._write

    def late(self, *arguments):
        apply(spark, table, [message("u", None, centre(1, "99"))], 1, 2, tmp_path)
        write(self, *arguments)

    monkeypatch.setattr(type(table), "_write", late)
    assert table.fold() == 0
    monkeypatch.setattr(type(table), "_write", write)
    assert state(table) == [(1, "99")]
    # Another one between the snapshot and clean-up.
    apply(spark, table, [message("u", None, centre(1, "100"))], 2, 3, tmp_path)
    table.drop_folded()
    assert state(table) == [(1, "100")]
    assert table.fold() == 2
    table.drop_folded()
    assert state(table) == [(1, "100")]


def test_another_checkpoint_is_refused(spark, tmp_path):
    def run(checkpoint):
        topic(spark, LOG[:2], 1).write.mode("overwrite").parquet(f"{tmp_path}/topic")
        table = keyed_table(spark, str(tmp_path), CENTRES)
        query = change_streams.start_feed(
            read_topic_files(spark, f"{tmp_path}/topic"), CENTRES, table, f"{tmp_path}/dead", f"{tmp_path}/{checkpoint}",
            availableNow=True,
        )
        query.awaitTermination()
        return state(table)

    assert run("one") == STATES[1]
    assert run("one") == STATES[1]
    with pytest.raises(StreamingQueryException, match="belongs to stream"):
        run("two")
    assert state(keyed_table(spark, str(tmp_path), CENTRES)) == STATES[1]


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path), CENTRES)
    apply(spark, table, LOG[:2], 0, 1, tmp_path)
    table.fold()
    option = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    table.read().limit(0).write.option(option, "false").parquet(f"{tmp_path}/{CENTRES.table}/snapshot/upto=9")
    assert state(table) == STATES[1]


def test_snapshot_then_changes(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path), CENTRES)
    snapshot = "id bigint, name string, latitude double, longitude double"
    table.load(spark.createDataFrame([(7, "old", 1.0, 2.0), (5, "kept", None, None)], snapshot))
    apply(spark, table, LOG, 0, 1, tmp_path)
    assert state(table) == [(5, "kept"), (7, "A2"), (8, "B3")]


def test_delete_of_an_item_carries_only_its_key(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path), ITEMS)
    first = message("c", None, {"id": 1, "order_id": 10, "sale_price": 2.5, "created_at": 1700000000123456})
    apply(spark, table, [first], 0, 1, tmp_path, ITEMS)
    row = table.read().first()
    assert (row.id, row.order_id, row.sale_price) == (1, 10, 2.5)
    apply(spark, table, [message("d", {"id": 1}, None)], 1, 2, tmp_path, ITEMS)
    assert table.read().count() == 0


def test_times_keep_microseconds(spark):
    text = message("c", None, {"id": 1, "created_at": 1700000000123456})
    flat = changes.flatten(changes.decode(topic(spark, [text]), ITEMS), ITEMS)
    assert flat.select(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0] == "2023-11-14 22:13:20.123456"


def test_renames_and_flag(spark):
    feed = CHANGE_FEEDS["products"]
    texts = [message("c", None, {"id": 3, "name": "n"}), message(None, None, {"id": 4}), message("d", {"id": 3}, None)]
    flat = changes.flatten(changes.decode(topic(spark, texts), feed), feed)
    assert flat.columns == [*feed.columns, "is_deleted"]
    assert rows(flat.select("product_id", "name", "is_deleted")) == [(3, "n", 0), (3, None, 1), (4, None, 0)]


def test_error_budget(spark, tmp_path):
    feed = dataclasses.replace(CENTRES, error_budget=1)
    table = keyed_table(spark, str(tmp_path), feed)
    bad, good = message("u", None, None), LOG[0]
    apply(spark, table, [bad, good], 0, 1, tmp_path, feed)
    assert state(table) == [(7, "A")]
    with pytest.raises(ErrorBudgetExceeded):
        apply(spark, table, [bad, bad, LOG[1]], 1, 3, tmp_path, feed)
    assert state(table) == [(7, "A")]
    from odsflow.schemas import DEAD_LETTERS

    assert read_batches(spark, str(tmp_path / "dead"), DEAD_LETTERS).count() == 3


def test_error_budget_over_many_batches(spark, tmp_path):
    """Few rejects a batch, but too many within the span."""
    feed = dataclasses.replace(CENTRES, error_budget=2, max_rows_per_batch=1)  # a span of ten offsets
    table = keyed_table(spark, str(tmp_path), feed)
    bad = message("u", None, None)
    apply(spark, table, [bad, LOG[0]], 0, 1, tmp_path, feed)
    apply(spark, table, [bad, bad], 1, 11, tmp_path, feed)  # the first is out of the span
    with pytest.raises(ErrorBudgetExceeded, match="3 rejected rows within 10 offsets"):
        apply(spark, table, [LOG[1], bad], 2, 18, tmp_path, feed)
    assert state(table) == [(7, "A")]


def test_lost_messages_stop_a_feed(spark, tmp_path):
    table = keyed_table(spark, str(tmp_path), CENTRES)
    dead, put = str(tmp_path / "dead"), lambda texts, batch, first: topic(spark, texts, first)
    apply_batch(put(LOG[:2], 0, 1), 0, CENTRES, table, dead, contiguous=True)
    with pytest.raises(LostMessages, match="t/0: 3 to 4"):
        apply_batch(put(LOG[2:3], 1, 5), 1, CENTRES, table, dead, contiguous=True)
    assert state(table) == STATES[1]
    apply_batch(put(LOG[2:4], 1, 3), 1, CENTRES, table, dead, contiguous=True)
    assert state(table) == STATES[3]


@pytest.mark.parametrize("block", [3, 1000])
def test_gaps_and_spans(spark, block):
    """Against plain loops."""
    chance = random.Random(block)
    seen = {(p, o) for p in (0, 1) for o in chance.sample(range(60), 35)}
    after = {0: -1, 1: 4}
    data = [("t", p, o) for p, o in [*seen, *chance.sample(sorted(seen), 9)]]
    messages = spark.createDataFrame(data, "topic string, partition int, offset bigint")
    last = spark.createDataFrame([("t", p, o) for p, o in after.items()], "topic string, partition int, last bigint")
    found = {(r.partition, o) for r in offsets.missing_offsets(messages, last, block=block).collect() for o in range(r.first_missing, r.last_missing + 1)}
    expected = set()
    for p in (0, 1):
        mine = {o for q, o in seen if q == p}
        new = {o for o in mine if o > after[p]}
        expected |= {(p, o) for o in range(after[p] + 1, max(new)) if o not in new}
    assert found == expected
    counted = offsets.count_in_span(messages.select("partition", "offset").distinct(), block)
    assert all(r.in_span == sum(r.offset - block < o <= r.offset for q, o in seen if q == r.partition) for r in counted.collect())
    assert counted.count() == len(seen)


def test_latest_by_key_with_a_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("version")
    )
    found = keyed.latest_by_key(df, ["key"], ["version"])
    assert found.count() == 20001
    assert found.where("key = 0").first().version == 29997


def test_upsert_updates_only_the_listed_columns(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z")], "k int, v string, w string")
    assert rows(keyed.upsert(target, new, ["k"], ["v"])) == [(1, "a", "x"), (2, "B", "y"), (3, "C", "Z")]
    assert rows(keyed.upsert(target, new, ["k"])) == [(1, "a", "x"), (2, "B", "Y"), (3, "C", "Z")]
    # An update to null is an update.
    cleared = spark.createDataFrame([(1, None, None)], "k int, v string, w string")
    assert rows(keyed.upsert(target, cleared, ["k"], ["v"])) == [(1, None, "x"), (2, "b", "y")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_log_in_any_batching(spark, tmp_path, seed):
    """Random changes, cuts, replays and snapshots against a dictionary."""
    choose = random.Random(seed)
    table = keyed_table(spark, str(tmp_path), CENTRES)
    table.n_parts = 3
    model, log = {}, []
    for n in range(60):
        key = choose.choice([1, 1, 1, 2, 3, 4, 7, 8])  # one key has more than a third of the changes
        if choose.random() < 0.3:
            log.append(message("d", {"id": key}, None, choose.random() < 0.5))
            model.pop(key, None)
        else:
            log.append(message("u", None, centre(key, f"n{n}"), choose.random() < 0.5))
            model[key] = f"n{n}"
    cuts = [0, *sorted(choose.sample(range(1, 60), 4)), 60]
    for batch, (start, end) in enumerate(itertools.pairwise(cuts)):
        for _ in range(choose.choice([1, 2])):
            apply(spark, table, log[start:end], batch, start, tmp_path)
        if choose.random() < 0.6:
            table.fold()
        if choose.random() < 0.5:
            table.drop_folded()
    assert dict(state(table)) == model
