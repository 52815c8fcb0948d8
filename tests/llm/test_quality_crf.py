from __future__ import annotations

import itertools

import numpy as np
from conftest import DATA
from pyspark.sql import functions as F

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm import quality_crf as Q
from odsflow.llm.common import table


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    odds, transition = rng.normal(size=(3, 4)), rng.normal(size=(2, 2))
    lengths = np.array([4, 1, 3])
    good, pairs, log_sum = Q.marginals(odds, lengths, transition)
    expected_pairs, expected_log = np.zeros((2, 2)), 0.0
    for s, n in enumerate(lengths):
        total, each = 0.0, np.zeros(n)
        seen = np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(sum(odds[s, t] for t in range(n) if labels[t]) + sum(transition[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            each += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                seen[a, b] += weight
        assert np.allclose(good[s, :n], each / total)
        expected_pairs += seen / total
        expected_log += np.log(total)
    assert np.allclose(pairs, expected_pairs) and np.isclose(log_sum, expected_log)


def test_held_out_accuracy(spark):
    labels = table(spark, DATA, "labels")
    found = Q.op3_line_crf(spark, DATA).join(labels, "doc_id").where("held_out")
    assert found.select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.85


def test_held_out_ranking(spark):
    """A constant has an area of 0.5 under the curve, and the accuracy of the larger class."""
    data = "/root/testdata/sf0.01"
    labels = table(spark, data, "labels")
    found = Q.op3_line_crf(spark, data).join(labels, "doc_id").where("held_out AND quality IS NOT NULL").toPandas()
    good, bad = found.score[found.quality == 1].to_numpy(), found.score[found.quality == 0].to_numpy()
    assert len(good) > 30 and len(bad) > 5
    area = (good[:, None] > bad[None, :]).mean() + (good[:, None] == bad[None, :]).mean() / 2
    assert area > 0.97
    majority = max(len(good), len(bad)) / len(found)
    assert (found.predicted == found.quality).mean() > majority + (1 - majority) / 2


def test_scores_do_not_depend_on_neighbours_in_the_batch():
    rng = np.random.default_rng(3)
    field = Q.Field(np.zeros(3 * Q.OWN), np.ones(3 * Q.OWN), rng.normal(size=3 * Q.OWN + 1), rng.normal(size=(2, 2)))
    texts = ["a b c.\nd e", "", None, " \n ", "x" * 9000, "one line!!\n" * 300, "mixed é\n\n\nlines | here"]
    together = Q.scores(texts, field)
    assert np.allclose(together, [Q.scores([t], field)[0] for t in texts])
    assert together[1] == together[2] == together[3] == 0


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0, 0), (8, 1, 0), (8, 0, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    field = Q.train(odd, labels)
    rows = Q.classify(odd.withColumn("quality_score", F.lit("clash")), field, odd.columns + ["quality_score"]).collect()
    assert len(rows) == 10 and all(0 <= r.quality_score <= 1 for r in rows)
    assert Q.classify(none, field, ["doc_id"]).collect() == []
    flat = Q.train(none, labels)
    assert not flat.weights.any()
    assert Q.good_only(odd, labels.limit(0)).columns == odd.columns


def test_training_takes_whole_documents_once(spark, monkeypatch):
    page = "\n".join([f"a clean line number {i}." for i in range(300)] + ["x | y | z"] * 100)
    docs = spark.createDataFrame([(1, page)] * 20 + [(2, "one line.")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int").where(~Q.held_out(F.col("doc_id")))
    assert labels.count() == 2
    collected, fitted, collect = [], [], type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda self: collected.append(collect(self)) or collected[-1].copy())
    monkeypatch.setattr(Q, "fit", lambda figures, owner, label: fitted.append(np.bincount(owner).tolist()))
    Q.train(docs, labels)
    assert [len(rows) for rows in collected] == [2]
    assert fitted == [[400, 1]]
