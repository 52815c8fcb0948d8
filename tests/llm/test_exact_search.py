from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from odsflow.llm import exact_search as S

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, asks, scale=64):
    kept = []
    for n, (vec_id, vector) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) and abs(x) * scale < 1 << 31 for x in vector):
            kept.append((n, vec_id, [math.floor(scale * x) for x in vector]))
    kept = [row for row in kept if sum(x * x for x in row[2]) < 1 << 61]
    out = []
    for _, query_id, q in kept:
        if query_id is None or not asks(query_id):
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), i is None, i) for _, i, v in kept if i != query_id and len(v) == len(q)]
        out += [(query_id, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def floats(rows):
    return [(i, [float(np.float32(x)) for x in v]) for i, v in rows]


def case(kind):
    chance = random.Random(7)
    if kind == "lengths":  # lengths from tiny to huge: length pruning
        return [(i, [chance.gauss(0, 1) * 2 ** (i % 12) for _ in range(6)]) for i in range(600)]
    if kind == "clusters":  # tight clusters: high cosines, coordinate pruning
        centres = [[chance.gauss(0, 1) for _ in range(8)] for _ in range(12)]
        return [(i, [c + chance.gauss(0, 0.01) for c in centres[i % 12]]) for i in range(900)]
    if kind == "equal":  # a third of all rows are one vector
        return [(i, [1.0, -1.0, 0.5] if i % 3 == 0 else [chance.uniform(-2, 2) for _ in range(3)]) for i in range(600)]
    return [(i, [-1.0 - chance.random(), 0.0] if i % 2 else [1.0 + chance.random(), 0.0]) for i in range(300)]  # negative scores


@pytest.mark.parametrize("bucket", [16, 4096])
@pytest.mark.parametrize("kind", ["lengths", "clusters", "equal", "signs"])
def test_same_as_all_products(spark, monkeypatch, kind, bucket):
    monkeypatch.setattr(S, "BUCKET", bucket)
    monkeypatch.setattr(S, "BLOCK", 7)
    rows = floats(case(kind))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = S.top_k(df, 5, F.col("vec_id") % 20 == 0).collect()
    assert ordered(found) == ordered(brute(rows, 5, lambda i: i % 20 == 0))


def test_pruning_touches_few_vectors():
    chance = np.random.default_rng(3)
    centres = chance.normal(0, 400, (40, 16))
    vectors = np.floor(centres[np.arange(4000) % 40] + chance.normal(0, 2, (4000, 16))).astype(np.int64)
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(1))
    bucket = S.Bucket(np.arange(4000), lengths, vectors)
    exact = np.sort(vectors[:1] @ vectors.T)[0][::-1]
    count, _, intervals = bucket.near(vectors[0].astype(float), lengths[0], exact[20] / (lengths[0] * bucket.top))
    places = bucket.inside(intervals)
    assert len(places) <= count < 2000 and np.isin(np.sort(vectors[0] @ vectors[bucket_places(bucket, places)].T)[-20:], exact[:21]).all()
    assert bucket.long_enough(bucket.top) >= 1 and bucket.long_enough(bucket.top * 2) == 0 and bucket.long_enough(0) == 4000


def bucket_places(bucket, places):
    return bucket.ids[places]


ODD = [
    (0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [3.0, -2.0]), (None, [5.0, 5.0]), (None, [5.0, 5.0]), (3, [5.0, 5.0]),
    (40, None), (60, []), (61, []), (80, [1.0]), (100, [1.0, None]), (120, [float("nan"), 1.0]), (140, [float("inf"), 1.0]),
    (160, [0.0, 0.0]), (180, [3e38, 1.0]), (200, [-1e7, 1e7]), (7, [1e7, -1e7]), (9, [3e7, -3e7]), (220, [1.0, 2.0, 3.0]),
]


def test_odd_rows(spark):
    schema = SCHEMA + ", id string, row int, v string, length int, score string"
    df = spark.createDataFrame([(a, b, "x", 1, "y", 2, "z") for a, b in ODD], schema)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert ordered(S.top_k(df, 3, F.col("vec_id") % 20 == 0).collect()) == ordered(brute(rows, 3, lambda i: i % 20 == 0))
    assert ordered(S.top_k(df, 50, F.lit(True)).collect()) == ordered(brute(rows, 50, lambda i: True))
    assert S.top_k(df, 3, F.lit(None).cast("boolean")).collect() == []
    assert S.top_k(df.limit(0), 3, F.lit(True)).collect() == []
