from __future__ import annotations

import collections
import hashlib
import random

import pytest
from conftest import DATA

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm import suffix_dedup as S
from odsflow.llm.common import table as read


def covered(texts):
    """By counting all windows: what is kept of each text, and the spans."""
    n = S.WINDOW
    counts = collections.Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if counts[t[i : i + n]] > 1:
                hit[i : i + n] = b"\1" * n
        kept = bytes(b for b, h in zip(t, hit) if not h)
        out.append((len(t), sum(hit), sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit)), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_array_against_sorting():
    rng = random.Random(4)
    for _ in range(300):
        text = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 50))] + [0]
        assert S.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_query_against_counting(spark, monkeypatch, crowd):
    monkeypatch.setattr(S, "CROWD", crowd)
    docs = read(spark, DATA, "documents").collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.op4_suffix_array(spark, DATA).collect()}
    expected = covered([(d.text or "").encode() for d in docs])
    assert found == {d.doc_id: e for d, e in zip(docs, expected)}


def test_planted_cases(spark, tmp_path):
    rng = random.Random(5)
    fresh = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, edge = fresh(260), fresh(200)
    texts = [
        None, "", "short", "z" * 199, "z" * 200, "q" * 201, "ab" * 400, passage, fresh(300) + passage + fresh(90),
        passage[:250] + fresh(80), edge, fresh(100) + edge, fresh(400), fresh(70_000) + passage + fresh(140_000),
        "same " * 60, "same " * 60,
    ]
    rows = [(i % 12, t, "en", "a", 1) for i, t in enumerate(texts)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, rid string, spans string, n_bytes long").write.parquet(path)
    found = S.op4_suffix_array(spark, str(tmp_path)).collect()
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == sorted(covered([(t or "").encode() for t in texts]))
    clean = S.without_repeats(spark.read.parquet(path))
    assert clean.count() == len(texts) and clean.columns == ["doc_id", "text", "rid", "spans", "n_bytes"]


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_runs_of_one_byte(spark, tmp_path, monkeypatch, crowd):
    monkeypatch.setattr(S, "CROWD", crowd)
    rng = random.Random(6)
    fresh = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    texts = [
        "q" * 201, "z" * 200, fresh(250) + "r" * 330 + fresh(250), "-" * 200 + fresh(220), fresh(210) + "-" * 230,
        "=" * 260, "=" * 260, fresh(90) + "=" * 700 + fresh(60), " " * 1500, "\n" * 300 + fresh(40) + "\n" * 455,
    ]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = S.op4_suffix_array(spark, str(tmp_path)).collect()
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(found)]
    assert got == covered([t.encode() for t in texts])


def test_odd_rows(spark, odd, none):
    assert S.without_repeats(none).collect() == []
    clean = S.without_repeats(odd).collect()
    assert len(clean) == 10
    by = {r.doc_id: r for r in clean}
    assert by[4].text == "word" and by[1].text == "" and by[6].text == "" and by[5].n_chars == len(by[5].text)
    assert by[7].text == odd.where("doc_id = 7").first().text


def test_rows_made_from_file_rows_are_told_apart(spark, tmp_path):
    spark.createDataFrame([(1, "x" * 300)], "doc_id long, text string").write.parquet(f"{tmp_path}/one")
    docs = spark.read.parquet(f"{tmp_path}/one")
    assert docs.count() == 1 and S._one_row_per_file_row(docs.where("doc_id > 0").select("text")._jdf.queryExecution().analyzed())
    assert len({r.rid for r in S._numbered(docs.selectExpr("text", "explode(array(1, 2)) AS copy")).collect()}) == 2
