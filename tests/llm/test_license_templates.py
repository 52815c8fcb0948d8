from __future__ import annotations

import random
import re

import pytest

from llm_fixtures import none, odd  # noqa: F401

from odsflow.llm.common import words
from odsflow.llm.license_templates import TEMPLATES, Automaton, _pattern, outermost, parse, scan


def accepted(templates, text):
    automaton = Automaton({k: parse(v) for k, v in templates.items()})
    return {automaton.labels[n] for _, n in automaton.ends(words(text))}


def test_optional_and_replaceable_regions():
    templates = {"t": "start <<beginOptional>>maybe <<beginOptional>>deep<<endOptional>> this<<endOptional>> <<var;words=2>> end"}
    for text in ("start end", "START maybe this end", "start maybe deep this x y end", "a start x end b"):
        assert accepted(templates, text) == {"t"}
    for text in ("start x y z end", "start maybe end end2"[:11], "start maybe deep en", "stop end"):
        assert accepted(templates, text) == set()


def test_random_templates_against_patterns():
    rng = random.Random(2)
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 5)):
            word = rng.choice("abc")
            parts.append(rng.choice([word, word, f"<<beginOptional>>{word} {rng.choice('abc')}<<endOptional>>", f"<<var;words={rng.randint(0, 2)}>>"]))
        template = "a " + " ".join(parts)
        for _ in range(20):
            text = " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 9)))
            joined = " " + "  ".join(text.split()) + " "
            expected = {"t"} if re.search(_pattern(parse(template)), joined) else set()
            assert accepted({"t": template}, text) == expected, (template, text)


def test_broken_markup():
    for template in ("a <<beginOptional>> b", "a <<endOptional>> b"):
        with pytest.raises(ValueError):
            parse(template)


def test_every_template_accepts_its_own_wording():
    for label, template in TEMPLATES.items():
        own = re.sub(r"<<var;words=\d+>>", " ", re.sub(r"<<(begin|end)Optional>>", " ", template))
        assert label in accepted(TEMPLATES, f"before {own} after")


def test_odd_rows(spark, odd, none):
    assert scan(none, ["doc_id"]).collect() == []
    more = odd.selectExpr("*", "'x' AS lt_words").union(odd.selectExpr("9", "'Released under the MIT License.'", "lang", "source", "n_chars", "'y'").limit(1))
    found = scan(more, ["doc_id", "lt_words"]).collect()
    assert len(found) == 11
    last = [r for r in found if r.doc_id == 9][0]
    assert (last.lt_words, [tuple(p) for p in last.lt_phrases], [tuple(p) for p in last.lt_templates]) == (5, [("mit", 3, 5)], [("mit-notice", 0, 5)])
    assert sum(len(r.lt_templates) for r in found) == 1


def test_outermost_spans_of_very_many():
    import random
    import time

    rng = random.Random(4)
    spans = list({(a, rng.choice("xy"), a + rng.randrange(1, 30)) for a in (rng.randrange(300) for _ in range(400))})
    slow = [s for s in spans if not any(o != s and o[1] == s[1] and o[0] <= s[0] and s[2] <= o[2] for o in spans)]
    assert outermost(spans) == sorted(slow)
    start = time.process_time()
    assert len(outermost([(20 * i, "mit", 20 * i + 18) for i in range(100_000)])) == 100_000
    assert time.process_time() - start < 5
