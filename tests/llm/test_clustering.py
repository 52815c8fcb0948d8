from __future__ import annotations

import collections
import hashlib
import math
import random

import pytest

from odsflow.llm import clustering as C

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, clusters, rounds, dimensions, scale=64, seed=1):
    """Plain Python: one list of integers for each usable row."""
    kept = []
    for vec_id, vector in rows:
        if vector is None or len(vector) != dimensions:
            continue
        if any(x is None or not math.isfinite(x) or abs(x) * scale > C.LARGEST for x in vector):
            continue
        kept.append((vec_id, [math.floor(scale * x) for x in vector]))
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, members in groups.items():
            centres[n] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    each = collections.Counter()
    for _, n, d in found:
        each[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, n, d, each[n], sum(each.values()), digest[n]) for i, n, d in found]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("width", [1, 2, 5])
@pytest.mark.parametrize("chunk", [7, 16_384])
def test_same_as_plain_rounds(spark, monkeypatch, width, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    chance = random.Random(5)
    rows = [(i, [float(round(chance.uniform(-3, 3), 1)) for _ in range(6)]) for i in range(150)]
    rows += [(1000 + i, [0.5, -0.5, 0.25, 0.0, 1.0, -1.0]) for i in range(80)]  # a third are equal
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]  # as floats
    assert ordered(C.cluster(df, 5, 4, 6, width=width).collect()) == ordered(brute(rows, 5, 4, 6))


ODD = [
    (1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [3.0, -2.0]),  # repeated rows and ids
    (None, [0.0, 0.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]),
    (7, [float("inf"), 1.0]), (8, [float("-inf"), 1.0]), (9, [3e38, 1.0]), (10, [-200_000.0, 200_000.0]), (11, [0.0, 0.0]),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(a, b, "x", 1, 2.0, "y") for a, b in ODD], SCHEMA + ", id string, cluster int, distance double, ids string")
    assert ordered(C.cluster(df, 3, 2, 2).collect()) == ordered(brute(ODD, 3, 2, 2))
    assert ordered(C.cluster(df, 50, 2, 2).collect()) == ordered(brute(ODD, 50, 2, 2))  # more centroids than vectors
    assert len(C.cluster(df, 3, 0, 2).collect()) == 6
    assert C.cluster(df, 3, 2, 9).collect() == []
    assert C.cluster(df.limit(0), 3, 2, 2).collect() == []


def test_dictionaries_lose_nothing():
    import numpy as np

    vectors = np.random.default_rng(0).integers(-3, 3, (500, 7)) * 1000
    codes, words = C._encode(vectors, 3)
    assert codes.shape == (500, 3) and [w.shape[1] for w in words] == [3, 3, 1]
    assert all(len(np.unique(w, axis=0)) == len(w) for w in words)
    assert (np.concatenate([w[codes[:, n]] for n, w in enumerate(words)], axis=1) == vectors).all()
