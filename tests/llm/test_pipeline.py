from __future__ import annotations

import corpus_pipeline as P
from conftest import DATA
from llm_fixtures import odd, table  # noqa: F401

from odsflow.llm.common import table as read
from odsflow.llm.common import written


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = read(spark, DATA, "documents")
    sizes = [docs.count()]
    for number, (name, stage) in enumerate(P.STAGES):
        out = written(stage(spark, docs, DATA), f"test-{name}")
        if number < len(P.STAGES) - 1:
            assert out.dtypes == docs.dtypes
        docs = out
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] >= sizes[4] == sizes[5] > 0
    assert docs.where("n_tokens <> size(sp_ids)").isEmpty()


def test_empty_and_odd_documents(spark, odd):
    for docs in (table(spark, []), odd):
        for _, stage in P.STAGES:
            docs = written(stage(spark, docs, DATA), "test-odd")
        assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "sp_ids"]


def test_what_each_stage_removes(spark):
    docs, labels = read(spark, DATA, "documents"), read(spark, DATA, "labels")
    known = docs.join(labels.where("quality = 1 AND toxic = 0"), "doc_id").where("lang = 'en' AND length(text) BETWEEN 2000 AND 9000")
    good = [r.text for r in known.orderBy("doc_id").limit(4).collect()]
    assert len(good) == 4
    junk = docs.join(labels.where("quality = 0"), "doc_id").where("length(text) > 200").orderBy("doc_id").first().text
    test = read(spark, DATA, "benchmark").where("size(split(text, ' ')) >= 15").orderBy("item_id").first().text
    # Wording of its own for each planted text, so that only what is planted is shared.
    own = lambda text, mark: " ".join(w + mark if i % 3 == 0 and w.isalpha() else w for i, w in enumerate(text.split(" ")))
    passage = "it was only when the " + " ".join(f"traveller{chr(97 + i % 26)}{chr(97 + i // 2 % 26)} had seen" for i in range(30))
    assert len(passage) > 400
    planted = {
        1_000_000: own(good[0], "qa"),
        1_000_001: own(good[0], "qa") + " one more line of text.",  # near copy
        1_000_002: own(good[1], "qb") + " " + passage,
        1_000_003: own(good[2], "qc") + " " + passage,  # repeated passage
        1_000_004: own(good[3], "qd") + " " + test,  # passage of a test
        1_000_005: junk + " x",
    }
    extra = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in planted.items()], "doc_id long, text string, lang string, source string, n_chars int")
    now = docs.unionByName(extra.select(*[extra[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns]))
    after = []
    for name, stage in P.STAGES[:-1]:
        now = written(stage(spark, now, DATA), f"test-{name}")
        after.append({r.doc_id: r.text for r in now.where("doc_id >= 1000000").collect()})
    quality, copies, passages, tests = after
    assert set(quality) == set(planted) - {1_000_005}
    assert len(set(copies) & {1_000_000, 1_000_001}) == 1 and {1_000_002, 1_000_003, 1_000_004} <= set(copies)
    assert copies[1_000_002] == planted[1_000_002] and passage in copies[1_000_003]
    assert all(passage[100:300] not in passages[i] and passages[i].startswith(planted[i][:1000]) for i in (1_000_002, 1_000_003))
    assert passages[1_000_004] == planted[1_000_004] and test not in tests[1_000_004]
    assert tests[1_000_004].startswith(planted[1_000_004][:1000]) and tests[1_000_002] == passages[1_000_002]
