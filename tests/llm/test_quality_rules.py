from __future__ import annotations

import random

from pyspark.sql import functions as F

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm import quality_rules as Q


def test_buckets_are_ordered_and_close(spark):
    values = [*range(200), 1000, 12345, 10**6, 10**9]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", Q.bucket(F.col("v")).alias("b"))
    rows = rows.select("v", "b", Q.bucket_value(F.col("b")).alias("m")).orderBy("v").collect()
    assert [r.b for r in rows] == sorted(r.b for r in rows)
    assert all(abs(r.m - r.v) <= r.v / 31 for r in rows)


def test_merged_sketches_equal_the_sketch_of_all(spark):
    rng = random.Random(13)
    df = spark.createDataFrame([(rng.choice("ab"), rng.choice("xyz"), rng.randrange(5000)) for _ in range(400)], "lang string, source string, v long")
    fine = Q.sketch(df, ["lang", "source"], ["v"])
    merged = Q.merge(fine, ["lang"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, Q.sketch(df, ["lang"], ["v"]).collect()))
    quarter = {r.lang: (r.q25, r.q75) for r in Q.quantiles(merged, ["lang"], [25, 75]).collect()}
    for lang, (q1, q3) in quarter.items():
        values = sorted(r.v for r in df.where(F.col("lang") == lang).collect())
        assert abs(q1 - values[(len(values) + 3) // 4 - 1]) <= q1 / 15 + 1
        assert abs(q3 - values[(3 * len(values) + 3) // 4 - 1]) <= q3 / 15 + 1


def test_figures_by_hand(spark, odd, none):
    texts = ["a b c d e f a b c d e", "l1 x\nl1 x\n \n\nl1 x", "#a $ %%", None, "\x0b\x0ca\rb\x1f", "é é é é é é"]
    rows = Q.figures(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    got = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]
    assert got == [(11, 11, 0, 0, 10), (6, 9, 0, 2, 0), (3, 5, 4, 0, 0), (0, 0, 0, 0, 0), (2, 3, 0, 0, 0), (6, 6, 0, 0, 6)]
    assert Q.adaptive_rules(none, ["doc_id"]).collect() == []
    judged = Q.adaptive_rules(odd.withColumn("cut_lang", F.lit("clash")), ["doc_id"]).collect()
    assert len(judged) == 10
    kept = {r.doc_id: (r.base_failed, r.kept) for r in judged}
    assert kept[1] == (True, False) and kept[8] == (False, True) and kept[5] == (True, False)


SCHEMA = "doc_id long, text string, lang string, source string"


def test_outliers_of_a_source_are_dropped(spark):
    rng = random.Random(14)
    good = [(i, " ".join("w" * rng.randint(2, 8) + str(rng.randrange(10**6)) for _ in range(40)), "en", "a") for i in range(150)]
    bad = [(900, " ".join(f"{'w' * 9}&&&{i}" for i in range(40)), "en", "a"), (901, " ".join("x" * 60 + str(i) for i in range(40)), "en", "a")]
    rows = Q.adaptive_rules(spark.createDataFrame(good + bad, SCHEMA), ["doc_id"]).collect()
    assert {r.doc_id for r in rows if not r.kept} == {900, 901}


def words(rng, n, length=5):
    return ["".join(rng.choices("abcdefghijklmnop", k=length)) + str(rng.randrange(10**6)) for _ in range(n)]


def texts_of(rng, source, first, n=120):
    """A plain source, and one that is unusual in every figure."""
    rows = []
    for i in range(n):
        if source == "plain":
            text = " ".join(words(rng, 200))
        else:
            body = words(rng, 200, 12)
            body[10:25] = body[30:45]  # 150 repeated words in a thousand
            lines = [" ".join(body[k : k + 10]) for k in range(0, 200, 10)]
            text = "\n#|%|%\n".join(lines)  # a line of symbols after each
        rows.append((first + i, text, "en", source))
    return rows


def test_the_same_text_is_judged_by_its_source(spark):
    """For each figure an outlier of the plain source that passes the base rule; the other source is full of such texts."""
    rng = random.Random(15)
    plain, odd_ones = texts_of(rng, "plain", 0), texts_of(rng, "odd", 1000)
    repeated = words(rng, 200)
    repeated[10:25] = repeated[30:45]
    lines = [" ".join(words(rng, 10)) for _ in range(20)]
    outliers = {
        "word_length": " ".join(words(rng, 200, 9)),
        "symbols": " ".join(words(rng, 190) + ["###|"] * 4),
        "dup_lines": "\n".join([*lines, *["same line"] * 4]),
        "repeated": " ".join(repeated),
    }
    planted = [(9000 + i, text, "en", source) for source in ("plain", "odd") for i, text in enumerate(outliers.values(), 10 * (source == "odd"))]
    docs = spark.createDataFrame([*plain, *odd_ones, *planted], SCHEMA)
    rows = {r.doc_id: r for r in Q.adaptive_rules(docs, ["doc_id"]).collect()}
    for i, figure in enumerate(outliers):
        assert not rows[9000 + i].base_failed and not rows[9000 + i].kept, figure
        assert rows[9010 + i].kept, figure
    assert all(rows[r[0]].kept for r in plain + odd_ones)
    cut = {r.source: r for r in Q.fences(Q.rates(Q.figures(docs))).collect()}
    assert all(cut["plain"][f"high_{f}"] < cut["odd"][f"high_{f}"] for f in Q.FIGURES)


def test_small_sources_lean_on_their_language(spark):
    """One odd text among a hundred is not enough for a cutoff of its own; the same share of a large source is judged alike."""
    rng = random.Random(16)
    rows = texts_of(rng, "plain", 0, 300) + [(5000 + i, t, g, f"s{i}") for i, (_, t, g, _) in enumerate(texts_of(rng, "plain", 0, 3))]
    cut = {r.source: r for r in Q.fences(Q.rates(Q.figures(spark.createDataFrame(rows, SCHEMA)))).collect()}
    assert len({(r.high_word_length, r.high_symbols, r.high_repeated) for r in cut.values()}) == 1
    # Weights: a source of one row has its own for 1 / (1 + PRIOR).
    mixed = Q.with_prior(spark.createDataFrame([("en", "a", "f", 1, 1), ("en", "b", "f", 2, 99)], "lang string, source string, figure string, bucket int, n long"))
    got = {(r.source, r.bucket): int(r.n) for r in mixed.collect()}
    assert got == {("a", 1): 100 + Q.PRIOR, ("a", 2): 99 * Q.PRIOR, ("b", 1): Q.PRIOR, ("b", 2): 9900 + 99 * Q.PRIOR}
