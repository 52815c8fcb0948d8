from __future__ import annotations

import bisect
import collections
import hashlib
import random

import pytest

from conftest import DATA
from llm_fixtures import none, odd, table  # noqa: F401

from odsflow.llm import alignment as A


@pytest.fixture(scope="module")
def aligner():
    return A.Aligner()


def alphabet():
    """As the published byte-level encoders build it: bytes that print, then the rest."""
    table, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


CHARS = alphabet()


def plain(aligner, text):
    """Groups of a whole text from decoded bytes alone; None without tokens."""
    if not text:
        return None
    ids_a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    ids_b = aligner.b.encode(text)
    bytes_a = [bytes(CHARS[c] for c in aligner.a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(aligner.b.id_to_piece(i)[3:5], 16)]) if aligner.b.is_byte(i) else aligner.b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None

    def ends(parts):
        out, at = [], 0
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    cuts = sorted(set(ends_a) & set(ends_b))
    out = [([], []) for _ in cuts]
    for side, (ids, ends_) in enumerate([(ids_a, ends_a), (ids_b, ends_b)]):
        for i, end in zip(ids, ends_):
            out[bisect.bisect_left(cuts, end)][side].append(i)
    return out


def brute(aligner, docs):
    groups = [(d, plain(aligner, t)) for d, t in docs]
    counts = collections.Counter()
    for _, g in groups:
        counts.update({(a, b) for x, y in g or [] for a in x for b in y})
    best = collections.Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for d, g in groups:
        links = [(a, b) for x, y in g or [] for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        digest = "" if g is None else hashlib.sha256(text.encode()).hexdigest()
        out.append((d, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), len(links),
                    sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), digest))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


ODD_TEXTS = [
    "a<|endoftext|>b </s> <s> <unk> <0x41>", "  two  spaces   three\n\n \n x ", "tab\t and\r\nlines   end", "é́ 日本語のテキスト \U0001f600\U0001f9d1‍\U0001f680x",
    "▁ mark", "foo▁ bar", "\x1c x\x1f y\x85 z\xa0 w", " ", "   ", "x ", "'s don't 'll it's", "ﬁ ① Å ｆｕｌｌ", "\x00 nul \x00", "ꙮ ܐܪܡܝܐ ગુજરાતી", "123 4567.89 --- ***",
]


def test_units_give_the_groups_of_whole_texts(aligner):
    chance = random.Random(3)
    pool = list(" \n\t  a1'é日\U0001f600▁.-") + ["the", " cat", " ", "ing", "  ", "don't", "ꙮ"]
    texts = ODD_TEXTS + ["".join(chance.choices(pool, k=chance.randint(1, 40))) for _ in range(1500)]
    known = A.Units(aligner)
    for text in texts:
        figures, digest, pairs, times = A._document(text, known)
        want = plain(aligner, text)
        joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want or [])
        assert digest == ("" if want is None else hashlib.sha256(joined.encode()).hexdigest()), repr(text)
        assert figures[3] == times.sum() == sum(len(x) * len(y) for x, y in want or [])
        assert [(a, b) for _, _, a, b in aligner.groups(text)] == (want or [])


@pytest.mark.parametrize("small", [False, True])
def test_same_as_brute_force(spark, monkeypatch, aligner, small):
    if small:  # many batches, forgotten units, long texts in blocks
        for name, value in {"BLOCK_CHARS": 50, "KNOWN_CHARS": 200, "ENCODE_CHARS": 30, "STRING_CHARS": 20, "LARGE_GROUP": 3, "BATCH_PAIRS": 300, "BATCH_DOCS": 5, "AHEAD_CHARS": 500}.items():
            monkeypatch.setattr(A, name, value)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(60)
    docs = docs.union(spark.createDataFrame([(10_000 + n, t) for n, t in enumerate(ODD_TEXTS)], "doc_id long, text string"))
    docs = spark.createDataFrame(docs.collect(), docs.schema).repartition(3)
    assert ordered(A.scored(docs).collect()) == ordered(brute(aligner, [tuple(r) for r in docs.collect()]))


def test_odd_rows(spark, aligner, odd, none):
    named = odd.selectExpr("*", "1 AS batch", "'x' AS id", "2 AS pairs", "3 AS n_a")
    assert ordered(A.scored(named).collect()) == ordered(brute(aligner, [(r.doc_id, r.text) for r in odd.collect()]))
    assert A.scored(none).collect() == []
    rows = A.spans(odd, ["doc_id", "source"]).collect()
    assert len(rows) == 10 and all((r.groups[-1]["end"] > 0) if r.groups else True for r in rows)
    word = next(r for r in rows if r.doc_id == 4)
    assert [(g["start"], g["end"]) for g in word.groups] == [(0, 5)]


def test_very_long_word_and_text(aligner):
    known = A.Units(aligner)
    figures, _, _, times = A._document("ab" * 300_000, known)
    assert figures[2] > 0 and times.sum() == figures[3]
    figures, digest, _, times = A._document("some words of a long text " * 200_000, known)
    assert figures[0] >= 1_200_000 and times.sum() == figures[3]
