from __future__ import annotations

import random

from conftest import DATA
from pyspark.sql import functions as F

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm import sentencepieces as S
from odsflow.llm.common import table as read

HARD = [
    "hello world", "  a  b ", " x", "É fi ﬁ", "a\nb\tc", "", None, "▁x", "日本 é́", "A▁B", "\xa0a　b", "a\x00b",
    "x" * 1000, "        " * 30 + "q", "ababababab" * 100, "▁▁", " ", "😀 " * 10,
]


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


def test_same_ids_as_the_library():
    rng = random.Random(12)
    letters = "abcdeotn hinTr.,\n é日▁  0"
    texts = HARD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(500)]
    model, reference = S.Model(), library()
    for encoder, times in ((S.Encoder(model), 2),):
        for _ in range(times):  # the second time all words are known
            ids, sizes = encoder.encode(texts)
            at = 0
            for text, size in zip(texts, sizes):
                mine = ids[at : at + size].tolist()
                assert mine == reference.encode(text or "")
                assert model.decode(mine) == reference.decode(mine)
                at += size


def test_small_chunks(monkeypatch):
    monkeypatch.setattr(S, "CHUNK_CHARS", 20)
    monkeypatch.setattr(S, "KNOWN_WORDS", 5)
    monkeypatch.setattr(S, "LONG_WORD", 4)
    encoder, reference = S.Encoder(S.Model()), library()
    for text in [t for t in HARD if t] + ["some longer words stand here again and again"]:
        ids, _ = encoder.encode([text])
        assert ids.tolist() == reference.encode(text)


def test_query_round_trip(spark):
    reference = library()
    docs = {d.doc_id: d.text for d in read(spark, DATA, "documents").collect()}
    found = S.op5_sentencepiece(spark, DATA).collect()
    assert len(found) == len(docs) and all(r.round_trip for r in found)
    assert all(r.n_tokens == len(reference.encode(docs[r.doc_id])) for r in found)


def test_odd_rows(spark, odd, none):
    ids = S.encode(odd.withColumn("sp_ids", F.lit("clash")), ["doc_id", "text", "sp_ids"])
    rows = S.decode(ids, ["doc_id", "text"]).collect()
    assert len(rows) == 10
    assert all(r.sp_text == (r.text or "").replace("▁", " ") for r in rows)
    assert S.encode(none, ["doc_id"]).collect() == [] and S.summaries(none, ["doc_id"]).collect() == []
