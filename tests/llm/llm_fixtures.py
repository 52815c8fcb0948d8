from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


#: Texts that every operator must take: null, empty, blank, one word, very long, odd characters, copies.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "word", "en", "a", 4),
    (5, "the cat sat on the mat and then it ran away home. " * 3000, "en", "a", None),
    (6, "x" * 50_000, "de", "b", None),
    (7, "\x00▁ é́ 日本 \U0001f600 a　b", "fr", None, None),
    (8, "one two three four five six seven eight nine ten eleven twelve", "en", "a", None),
    (8, "one two three four five six seven eight nine ten eleven twelve", "en", "a", None),
    (None, "one two three four five six seven eight nine ten eleven twelve", "en", "a", None),
]


@pytest.fixture
def odd(spark):
    return table(spark, ODD)


@pytest.fixture
def none(spark):
    return table(spark, [])
