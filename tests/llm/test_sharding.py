from __future__ import annotations

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm import sharding as S


@pytest.mark.parametrize("range_rows", [4096, 3])
def test_shards_are_even_and_hold_the_mixture(spark, monkeypatch, range_rows):
    monkeypatch.setattr(S, "RANGE_ROWS", range_rows)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, F.lit(None)).otherwise("cold").alias("source"))
    rows = S.interleave(docs, 7, "source", ["doc_id"], seed=3).collect()
    counts = collections.Counter(r.shard for r in rows)
    assert len(rows) == 1000 and set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(7) for i in range(counts[s])]
    for source, total in collections.Counter(r.source for r in rows).items():
        each = collections.Counter(r.shard for r in rows if r.source == source)
        assert all(abs(each[s] - total / 7) <= 2 for s in range(7))
    again = S.interleave(docs.repartition(5), 7, "source", ["doc_id"], seed=3).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in rows) == sorted((r.doc_id, r.shard, r.slot) for r in again)
    other = S.interleave(docs, 7, "source", ["doc_id"], seed=4).collect()
    assert sorted((r.doc_id, r.shard) for r in rows) != sorted((r.doc_id, r.shard) for r in other)


def test_odd_rows(spark, odd, none):
    assert S.interleave(none, 24, "source", ["doc_id"]).collect() == []
    named = odd.withColumns({"shard": F.lit("old"), "key": F.lit("clash"), "row": F.lit(1), "rank": F.lit(2)})
    out = S.interleave(named, 24, "source", ["doc_id"])
    rows = out.collect()
    assert len(rows) == 10 and len({(r.shard, r.slot) for r in rows}) == 10 and {r.key for r in rows} == {"clash"}


def test_repeated_rows_are_dealt_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(S, "RANGE_ROWS", 16)
    rows = [(7, "a")] * 500 + [(8, "a")] * 90 + [(7, "b")] * 40 + [(i, "ab"[i % 2]) for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").repartition(6)
    split, pieces = S._split_hot_keys, []
    monkeypatch.setattr(S, "_split_hot_keys", lambda dealt: pieces.append(split(dealt)) or pieces[-1])
    found = sorted((r.source, r.doc_id, r.shard, r.slot) for r in S.interleave(docs, 5, "source", ["doc_id"], seed=3).collect())
    fractions = []
    for source in "ab":
        own = sorted((hashlib.md5(f"3\x1f{i}".encode()).hexdigest(), i) for i, s in rows if s == source)
        fractions += [((2 * r + 1) / (2 * len(own)), "s" + source, key, i) for r, (key, i) in enumerate(own)]
    places = [(p * 5 // len(rows), s[1:], i) for p, (_, s, _, i) in enumerate(sorted(fractions))]
    first = {shard: min(p for p, place in enumerate(places) if place[0] == shard) for shard in range(5)}
    assert found == sorted((s, i, shard, p - first[shard]) for p, (shard, s, i) in enumerate(places))
    heaviest = pieces[0].groupBy("source", "range", "floor", "part").count().agg(F.max("count")).first()[0]
    assert heaviest <= 3 * S.RANGE_ROWS
