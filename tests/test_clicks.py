from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from odsflow.functions import clicks as c
from odsflow.operators import clicks
from odsflow.schemas import BAD_FIELDS, BAD_JSON, BAD_TIME, EVENTS


@pytest.mark.parametrize(
    ("uri", "page", "product"),
    [
        ("/home", "home", None),
        ("/", "", None),
        ("", "unknown", None),
        (None, "unknown", None),
        ("/product/123", "product", 123),
        ("/product/", "product", None),
        ("/product/abc", "product", None),
        ("product/7/", "product", 7),
        ("/cancel/item/9", "post_purchase", None),
        ("/return", "post_purchase", None),
        ("//home", "", None),
        ("/department/men/category/jeans", "department", None),
    ],
)
def test_uri(spark, uri, page, product):
    df = spark.createDataFrame([(uri,)], "uri string")
    found = df.select(c.page_type(F.col("uri")), c.product_id(F.col("uri"))).first()
    assert tuple(found) == (page, product)


def click(**changes):
    body = {
        "id": 1,
        "user_id": None,
        "session_id": "s",
        "uri": "/product/5",
        "event_type": "product",
        "created_at": "2024-01-01T10:00:00",
        "other": "ignored",
    }
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v != "drop"})


def topic(spark, *texts):
    data = [(None if t is None else bytearray(t.encode()),) for t in texts]
    return spark.createDataFrame(data, "value binary")


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (click(), None),
        ("not json", BAD_JSON),
        ("", BAD_JSON),
        ("{}", BAD_FIELDS),
        ("null", BAD_FIELDS),
        (click(id="x"), BAD_FIELDS),
        (click(session_id="drop"), BAD_FIELDS),
        (click(created_at=None), BAD_FIELDS),
        (click(event_type="search"), BAD_FIELDS),
        (click(created_at="bad"), BAD_TIME),
    ],
)
def test_route_of_a_message(spark, text, reason):
    parsed = clicks.parse(topic(spark, text))
    dead = [tuple(r) for r in clicks.dead_letters(parsed).select("raw_message", "error_message").collect()]
    assert dead == ([(text, reason)] if reason else [])
    assert clicks.valid(parsed).count() == (0 if reason else 1)


def test_messages_without_value_go_nowhere(spark):
    parsed = clicks.parse(topic(spark, None))
    assert parsed.count() == 0


def test_batch_dedup_keeps_same_id_at_other_time(spark):
    parsed = clicks.parse(topic(spark, click(), click(), click(created_at="2024-01-01T10:00:01")))
    assert clicks.deduplicate(clicks.valid(parsed)).count() == 2


def test_enrich(spark):
    at = F.lit("2024-01-01 10:00:02.5").cast("timestamp")
    row = clicks.enrich(clicks.valid(clicks.parse(topic(spark, click(event_type="purchase")))), at)
    assert row.schema.fieldNames() == EVENTS.fieldNames()
    assert [f.dataType for f in row.schema.fields] == [f.dataType for f in EVENTS.fields]
    found = row.first()
    assert (found.event_id, found.page_type, found.product_id, found.is_conversion) == (1, "product", 5, True)
    assert found.event_lag_seconds == 2.5
    assert str(found.event_date) == "2024-01-01"


def test_json_is_parsed_once(spark):
    """A filter on decoded fields must not repeat the parse."""
    found = clicks.valid(clicks.parse(topic(spark, click())))
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_parsed_rows_match_by_hand(spark):
    texts = [click(id=n, created_at=f"2024-01-01T10:00:0{n}") for n in range(3)]
    found = clicks.valid(clicks.parse(topic(spark, *texts))).select("id", F.date_format("event_timestamp", "ss"))
    assert rows(found) == [(0, "00"), (1, "01"), (2, "02")]
