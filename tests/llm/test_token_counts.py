from __future__ import annotations

import random
import time

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm import token_counts as C
from odsflow.llm.common import table as read


def test_edits_against_counting_again():
    rng = random.Random(15)
    letters = ["a", "b", " ", "  ", "\n", "'s", "'", "é", "1", "2", ".", "!?", "word", " the", "\t", "日"]
    some = lambda n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
    counter = C.Counter()
    for _ in range(500):
        text = some(40)
        tree = C.TokenTree(text, counter)
        for _ in range(5):
            a = rng.randint(0, len(text))
            b, new = min(len(text), a + rng.randint(0, 8)), some(5)
            tree.replace(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text == text and tree.total == len(counter.encoding.encode_ordinary(text))
            assert [size for leaf in tree.leaves for size, _ in leaf] == [len(p) for p in counter.split.findall(text)]


def test_an_edit_encodes_little():
    counter = C.Counter()
    tree = C.TokenTree("some words that are here " * 2000, counter)
    tree.replace(20_000, 20_010, "other things")
    assert tree.encoded < 20
    with pytest.raises(ValueError):
        tree.replace(5, 10**9, "")


@pytest.mark.parametrize("forward", [True, False])
def test_thousands_of_adjacent_edits(forward):
    counter, start = C.Counter(), time.process_time()
    text = "ab, cd. " * 6000
    tree = C.TokenTree(text, counter)
    places = [10 * i for i in range(4800)]  # 4,800 edits side by side in 48,000 characters
    for place in places if forward else reversed(places):
        before = tree.encoded
        tree.replace(place, place + 10, "Wx yz 12;;"[: 10 - place // 10 % 2] + "q" * (place // 10 % 2))
        assert tree.encoded - before <= 2 * C.LEAF + 20
    for place in range(3000):  # and at one place
        tree.replace(100, 100, " in")
    assert tree.total == len(counter.encoding.encode_ordinary(tree.text))
    assert max(map(len, tree.leaves)) <= C.LEAF + 20
    assert time.process_time() - start < 60


def test_query_against_counting_again(spark):
    encoding = C.Counter().encoding
    docs = {d.doc_id: d.text for d in read(spark, DATA, "documents").collect()}
    rows = C.op7_edit_aware_counts(spark, DATA).collect()
    assert len(rows) == len(docs) and sum(r.n_edits for r in rows) > 0
    for r in rows:
        text = docs[r.doc_id]
        assert r.n_tokens == len(encoding.encode_ordinary(text))
        for start, end, new in reversed(C.redactions(text)):
            text = text[:start] + new + text[end:]
        assert r.n_tokens_after == len(encoding.encode_ordinary(text))


def test_odd_rows(spark, odd, none):
    rows = C.edited_counts(odd.withColumn("n_tokens", F.lit("clash")), ["doc_id", "n_tokens"]).collect()
    assert len(rows) == 10 and all(r.n_tokens == r.n_tokens_after for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[1] == 0
    assert C.edited_counts(none, ["doc_id"]).collect() == []
