from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm import near_duplicates as N
from odsflow.llm.common import components, table as read


def brute(texts):
    """Classes and links of different texts by comparing all pairs."""
    different = sorted({t for t in texts if t and N.words(t)})
    sets = {t: set(s.tolist()) for t, s in zip(different, N.shingle_sets(different))}
    links, root = {t: 0 for t in different}, {t: t for t in different}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(different):
        for b in different[i + 1 :]:
            if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    return {t: find(t) for t in different}, links


def check(spark, rows):
    staged, classes = N.near_classes(spark.createDataFrame(rows, "doc_id long, text string, rid string"))
    found = classes.join(staged.select("rid", "whole"), "rid").collect()
    assert len(found) == len(rows)
    expected, links = brute([r[1] for r in rows])
    pairs = {(r.root, expected[r.whole]) for r in found if r.whole in expected}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert all(r.n_links == links[r.whole] for r in found if r.whole in links)
    lone = [r for r in found if r.whole not in links]
    assert all(r.root == r.rid and r.n_links == 0 and r.n_copies == 1 for r in lone)


def variants(rng, words, edits, count):
    out = []
    for _ in range(count):
        text = list(words)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = f"w{rng.randrange(1000)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("leaf, block", [(2048, 1_000_000), (8, 500)])
def test_against_all_pairs(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(N, "LEAF", leaf)
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(6)
    texts = [None, "", " . ", "one", "one", "One!", "two words"]
    for size in (40, 100):
        texts += variants(rng, [f"v{rng.randrange(500)}" for _ in range(size)], 6, 40)
    shared = [f"s{i}" for i in range(60)]
    texts += [" ".join(shared + [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))]) for _ in range(40)]
    texts += texts[20:40]
    check(spark, [(i if i % 7 else None, t, "x") for i, t in enumerate(texts)])


def test_query_against_all_pairs(spark):
    docs = read(spark, DATA, "documents").select("doc_id", "text").collect()
    expected, links = brute([d.text for d in docs])
    found = {r.doc_id: r for r in N.op8_chosen_path(spark, DATA).collect()}
    assert len(found) == len(docs)
    first = {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        if d.text in expected:
            first.setdefault(expected[d.text], d.doc_id)
            assert found[d.doc_id].class_id == first[expected[d.text]]
            assert found[d.doc_id].n_links == links[d.text]


def test_one_of_each(spark, odd, none):
    assert N.one_of_each(none).collect() == []
    kept = N.one_of_each(odd.withColumn("root", F.lit("clash")))
    rows = kept.collect()
    assert kept.columns == [*odd.columns, "root"]
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "4", "5", "6", "7", "8"]


def test_runs_reach_the_recall():
    assert (1 - N.success(N.DEPTH)) ** N.runs(0.999) <= 0.001
    rng = np.random.default_rng(7)
    a = np.unique(rng.integers(0, 1 << 63, 900).astype(np.uint64))
    b = np.unique(np.concatenate([a[:800], rng.integers(0, 1 << 63, 100).astype(np.uint64)]))
    same = (N.minimal_hashes(a) == N.minimal_hashes(b)).mean()
    assert abs(same - 0.8) < 0.2


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    alone = {n for n in root if all(a == b for a, b in edges if n in (a, b))}
    assert found == {n: find(n) for n in root if n not in alone}


def test_runs_reach_the_target_at_every_depth():
    assert N.missed(N.runs()) <= 1 - N.RECALL < N.missed(N.runs() - 1)
    assert all(N.missed(N.runs(), depth) <= 1 - N.RECALL for depth in range(1, N.DEPTH + 1))


@pytest.mark.parametrize("common", [0, 300, 480])
def test_recall_at_the_threshold_in_crowded_nodes(spark, monkeypatch, common):
    """Pairs of a similarity just over 0.8; all texts share wording, and nodes are split down to the last depth."""
    monkeypatch.setattr(N, "LEAF", 8)
    rng = random.Random(common)
    shared = [f"c{i}" for i in range(common)]
    rows = []
    for pair in range(250):
        own = [f"p{pair}w{rng.randrange(10**9)}" for _ in range(700 - common)]
        other = own[:100] + [f"q{pair}w{rng.randrange(10**9)}" for _ in range(73)] + own[173:]
        rows += [(2 * pair, " ".join(shared + own)), (2 * pair + 1, " ".join(shared + other))]
    a, b = (set(x.tolist()) for x in N.shingle_sets([rows[0][1], rows[1][1]]))
    assert 0.8 <= len(a & b) / len(a | b) < 0.802
    staged, classes = N.near_classes(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, rid string"))
    found = classes.where("n_links > 0").count()
    assert found >= 2 * 250 * 0.99


def test_a_comparison_of_shingles_found_in_sixteen_texts_holds_no_list_of_their_pairs():
    rng = np.random.default_rng(3)
    texts, shingles = 1600, 60
    columns = rng.integers(0, 1 << 63, texts * shingles // 16, dtype=np.uint64)
    rows = np.concatenate([rng.permutation(texts) for _ in range(shingles)])
    found = [np.unique(np.repeat(columns, 16)[rows == text]) for text in range(texts)]
    found[7], found[1500] = found[3], found[3][1:]  # linked, across any two sides as well
    for side in (np.zeros(texts, int), np.repeat([1, 2], texts // 2)):
        tracemalloc.start()
        links, least = N._compare(np.arange(texts), found, side)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        matrix = 1024 * texts * 4 if not side.any() else 800 * 800 * 4
        assert peak < matrix + 200 * texts * shingles, peak
        expected = np.zeros(texts, int)
        expected[[3, 7, 1500]] = (1, 1, 2) if side.any() else 2
        assert links.tolist() == expected.tolist()
        assert set(least[[3, 7, 1500]].tolist()) == {3} and len(set(least.tolist())) == texts - 2
