from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm import decontamination as D
from odsflow.llm.common import words


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - D.WINDOW + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + D.WINDOW]), set()).add(item)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                here = windows.get(tuple(w[i : i + size]))
                if here:
                    hit |= set(range(i, i + size))
                    found |= here
        out.append((len(w), len(hit), sorted(found), sum(i - 1 not in hit for i in hit)))
    return out


def random_case(rng, docs=30):
    word = lambda: rng.choice(["a", "b", "c", "d", "x1", "É", "z"])
    items = [(str(i), " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))) for i in range(12)]
    texts = [None, "", "."]
    for _ in range(docs):
        text = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(items)[1].upper().split()
        texts.append(rng.choice([" ", ", ", "\n"]).join(text))
    return texts, items


def test_index_against_scanning(monkeypatch):
    rng = random.Random(9)
    for shard in (1_000_000, 50):
        monkeypatch.setattr(D, "SHARD_WORDS", shard)
        for _ in range(20):
            texts, items = random_case(rng)
            tests = D.Tests([(i, t.encode()) for i, t in items])
            found = D._scan([t.encode() if t is not None else None for t in texts], tests)
            assert [(w, h, i, len(s)) for w, h, i, s in zip(*found)] == brute(texts, items)


def test_suffix_order_and_locate():
    rng = np.random.default_rng(10)
    for _ in range(30):
        symbols = np.append(rng.integers(0, 3, 200) * (rng.random(200) < 0.97), 0)
        order = D.suffix_order(symbols, 2)
        ends = np.append(np.flatnonzero(symbols == 0), len(symbols))
        key = lambda i: (symbols[i : ends[np.searchsorted(ends, i)]].tolist(), i)
        assert order.tolist() == sorted(range(len(symbols)), key=key)
        index = D.FMIndex(symbols, 2)
        rows = np.flatnonzero(symbols[order] > 0)
        assert index.locate(rows).tolist() == order[rows].tolist()


def test_blocks_of_tests_and_odd_rows(spark, odd, none, monkeypatch):
    rng = random.Random(11)
    texts, items = random_case(rng)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, dc_hit string")
    rows = [(int(i), t) for i, t in items] + [(None, None), (3, "one two three four five six seven eight nine ten")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    monkeypatch.setattr(D, "BLOCK_BYTES", 60)
    found = D.decontaminate(docs, bench).orderBy("doc_id").collect()
    expected = brute(texts, [*items, ("3", rows[-1][1])])
    assert [(r.dc_words, r.dc_hit, r.dc_items, len(r.dc_spans)) for r in found] == expected
    assert D.decontaminate(none, bench).collect() == []
    assert all(r.dc_hit == 0 for r in D.decontaminate(odd, bench.limit(0)).collect())
    clean = D.without_tests(odd.withColumn("dc_items", F.lit(1)), bench)
    assert clean.count() == 10
    kept = {r.doc_id: r.text for r in clean.collect()}
    assert kept[8] == " eleven twelve" and kept[1] is None and kept[4] == "word"


def test_repeated_tests_do_not_fill_a_block(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "one two three four")] * 50 + [(2, "two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "zero one two three four five")], "doc_id long, text string")
    monkeypatch.setattr(D, "BLOCK_BYTES", 40)
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or send(self, value))
    found = D.decontaminate(docs, bench).collect()
    assert [(r.dc_hit, r.dc_items) for r in found] == [(4, ["1", "2"])]
    assert [len(block) for block in sent] == [2]


def test_long_tests_are_cut_at_overlaps():
    rng = random.Random(12)
    for _ in range(50):
        text = " ".join(rng.choice(["a", "bb", "ccc", "dddd", "É" * 9]) for _ in range(rng.randint(0, 60)))
        runs = D.pieces(text.encode(), rng.randint(1, 80))
        windows = lambda w: {tuple(w[i : i + D.WINDOW]) for i in range(max(len(w) - D.WINDOW + 1, 1) if w else 0)}
        assert set().union(*(windows(words(run.decode())) for run in runs)) == windows(words(text))


def test_one_block_is_held_at_a_time(spark, monkeypatch):
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(400)]
    # One test is longer than all blocks but one together.
    items = [("9", " ".join(rng.choice(vocabulary) for _ in range(900)))]
    items += [(str(i), " ".join(rng.choice(vocabulary) for _ in range(20))) for i in range(9)]
    texts = [None, ""]
    for _ in range(60):
        name, test = rng.choice(items)
        w, at = test.split(), rng.randint(0, 5)
        texts.append(" ".join(["x", *w[at : at + rng.randint(5, 300)], "y", *rng.choice(items)[1].split()[:12]]))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    monkeypatch.setattr(D, "BLOCK_BYTES", 2000)
    sizes, live, most, send = [], set(), [], type(spark.sparkContext).broadcast

    def broadcast(self, value):
        shared = send(self, value)
        end = shared.destroy
        shared.destroy = lambda *a: (live.discard(id(shared)), end(*a))
        live.add(id(shared))
        sizes.append(sum(len(text) for _, text in value))
        most.append(len(live))
        return shared

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    found = D.decontaminate(docs, bench, ["doc_id"]).orderBy("doc_id").collect()
    assert [(r.dc_words, r.dc_hit, r.dc_items, len(r.dc_spans)) for r in found] == brute(texts, items)
    assert len(sizes) >= 3 and max(most) == 1 and not live
    assert max(sizes) < 2 * D.BLOCK_BYTES
