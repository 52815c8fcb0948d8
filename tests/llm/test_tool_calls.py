from __future__ import annotations

import json
import random

from odsflow.llm.tool_calls import SCHEMAS, canonical, derived_calls, errors, link_calls, references

CALLS = "conv_id long, call_id string, name string, arguments string, extra string"
RESULTS = "conv_id long, call_id string, content string, name string"


def linked(spark, calls, results):
    return {(r.conv_id, r.call_id): r for r in link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()}


def search(limit=3, after=None):
    value = {"query": "q", "limit": limit} | ({"after": {"$ref": after}} if after else {})
    return json.dumps(value)


def test_status_and_order(spark):
    calls = [
        (1, "a", "search", search(), "x"),
        (1, "b", "search", search(after="a"), None),
        (1, "c", "search", search(after="b"), None),
        (1, "bad", "search", search(limit=99), None),
        (1, "lost", "search", search(after="nowhere"), None),
        (1, "p", "search", search(after="q"), None),
        (1, "q", "search", search(after="p"), None),
        (1, "twice", "search", search(1), None),
        (1, "twice", "search", search(2), None),
        (1, "same", "search", search(), None),
        (1, "same", "search", search(), None),
        (1, "open", "search", search(), None),
        (1, "text", "search", "{not json", None),
        (1, "nan", "search", '{"query": "q", "limit": NaN}', None),
        (1, "none", None, None, None),
        (1, None, "search", search(), None),
        (None, "a", "search", search(), None),
        (2, "a", "unknown", "{}", None),
    ]
    results = [(1, c, f"r{c}", "clash") for c in ("a", "b", "c", "bad", "lost", "p", "q", "twice", "same", "text", "nan")]
    results += [(1, "orphan", None, None), (1, None, "x", None), (2, "a", 'say "hi"\n', None), (1, "a", "ra", None)]
    found = linked(spark, calls, results)
    loose = [key for key in found if None in key]
    assert sorted(loose, key=str) == [(1, None), (None, "a")] and {found[key].status for key in loose} == {"no_identifier"}
    found = {key: row for key, row in found.items() if None not in key}
    status = {key[1]: row.status for key, row in found.items() if key[0] == 1}
    assert status == {
        "a": "ok", "b": "ok", "c": "ok", "bad": "invalid", "lost": "dangling", "p": "cycle", "q": "cycle",
        "twice": "duplicate", "same": "ok", "open": "no_result", "text": "invalid", "nan": "invalid", "none": "invalid",
        "orphan": "no_call",
    }
    assert [found[1, c].level for c in "abcpq"] == [0, 1, 2, None, None]
    assert found[2, "a"].problems == "$: unknown tool"
    assert json.loads(found[2, "a"].message) == {"arguments": {}, "call_id": "a", "name": "unknown", "result": 'say "hi"\n'}
    assert len(found) == 15
    for row in found.values():
        assert canonical(json.loads(row.message)) == row.message


def test_empty_tables(spark):
    assert linked(spark, [], []) == {}
    assert linked(spark, [], [(1, "a", "r", None)])[1, "a"].status == "no_call"


def test_schema_rules():
    schema = {"type": "object", "properties": {"n": {"type": "integer", "minimum": 1}, "l": {"type": "array", "items": {"type": "string"}, "minItems": 1}}, "required": ["n"], "additionalProperties": False}
    assert errors({"n": 1, "l": ["a"]}, schema) == []
    assert errors({"n": 1.0}, schema) == []
    assert errors({"n": True}, schema) == ["$.n: type"]
    assert errors({"n": 0, "l": [], "x": 1}, schema) == ["$.l: minItems", "$.n: minimum", "$.x: additionalProperties"]
    assert errors({"l": [1]}, schema) == ["$.n: required", "$.l[0]: type"]
    assert errors("a", {"enum": ["b"]}) == ["$: enum"] and errors(1, {"enum": [True]}) == ["$: enum"]
    assert errors("abc", {"pattern": "^b"}) == ["$: pattern"]


def test_canonical_form():
    assert canonical({"b": [1.0, "é"], "a": {"d": None, "c": True}}) == '{"a":{"c":true,"d":null},"b":[1,"é"]}'
    assert references({"a": [{"$ref": "x"}, {"b": {"$ref": "y"}}], "$ref": 3}) == {"x", "y"}


def test_numbers_and_keys_of_the_canonical_form():
    written = {
        1e16: "10000000000000000", 1e20: "100000000000000000000", 1e21: "1e+21", 1.5e300: "1.5e+300", 0.000001: "0.000001",
        1e-7: "1e-7", -2.5e-9: "-2.5e-9", -0.0: "0", 0.1: "0.1", -12.75: "-12.75", 100.0: "100", 333333333.33333329: "333333333.3333333",
    }
    for value, text in written.items():
        assert canonical(value) == text and json.loads(text) == value
    assert canonical(2**70) == str(2**70)
    # U+1F600 is a pair of surrogates, which come before U+FB33.
    assert canonical({"\ufb33": 1, "\U0001f600": 2, "a": 3}) == '{"a":3,"\U0001f600":2,"\ufb33":1}'
    assert canonical("\x1f\n\u2028\x7f/") == '"\\u001f\\n\u2028\x7f/"'


def test_rows_without_identifiers_come_back(spark):
    calls = [(1, None, "search", search(), "x")] * 2 + [(None, None, None, None, None), (None, "b", "search", "{", None)]
    results = [(1, None, "r", None), (None, "b", None, None)]
    frame = link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)
    rows = sorted((str(r.conv_id), str(r.call_id), str(r.name), r.problems, r.message) for r in frame.collect())
    assert [r[:4] for r in rows] == [
        ("1", "None", "None", ""), ("1", "None", "search", ""), ("None", "None", "None", "$: json"),
        ("None", "b", "None", ""), ("None", "b", "search", "$: json"),
    ]
    assert rows[0][4] == '{"arguments":null,"call_id":null,"name":null,"result":"r"}'
    assert {r.status for r in frame.collect()} == {"no_identifier"} and {r.level for r in frame.collect()} == {None}


def brute(calls, results):
    """Status and level of every identifier, by walking the references of each conversation."""
    asked, answered = {}, {}
    for conv, call, name, arguments, _ in calls:
        asked.setdefault((conv, call), set()).add((name, arguments))
    for conv, call, content, _ in results:
        answered.setdefault((conv, call), set()).add(content)
    chosen = {key: min(versions) for key, versions in asked.items()}
    refs = {key: {(key[0], r) for r in references(json.loads(arguments))} for key, (_, arguments) in chosen.items()}
    level, changed = {}, True
    while changed:
        changed = False
        for key in chosen:
            known = [level.get(r) for r in refs[key] if r in chosen]
            if key not in level and None not in known:
                level[key], changed = max(known, default=-1) + 1, True
    out = {}
    for key in asked.keys() | answered.keys():
        several = len(asked.get(key, ())) > 1 or len(answered.get(key, ())) > 1
        wrong = key in chosen and errors(json.loads(chosen[key][1]), SCHEMAS["search"])
        lost = any(r not in chosen for r in refs.get(key, ()))
        rules = [(several, "duplicate"), (wrong, "invalid"), (lost, "dangling"), (key in chosen and key not in level, "cycle"),
                 (key not in answered, "no_result"), (key not in chosen, "no_call"), (True, "ok")]
        out[key] = (next(name for holds, name in rules if holds), level.get(key))
    return out


def test_random_references_against_brute_force(spark):
    rng = random.Random(5)
    calls, results = [], []
    for conv in range(40):
        size = rng.randint(1, 14)
        for n in range(size):
            several = rng.random() < 0.4
            near = [f"c{rng.choice([n - 1, n - 1, n - 2, rng.randint(0, size)])}" for _ in range(rng.randint(2, 3) if several else 1)]
            value = {"query": "q", "limit": rng.choice([1, 1, 1, 1, 1, 99])}
            if rng.random() < 0.85:
                # References further down count too.
                value["after"] = {"$ref": near[0], "more": [{"$ref": r} for r in near[1:]]}
            calls += [(conv, f"c{n}", "search", json.dumps(value), None)] * rng.choice([1, 1, 2])
            if rng.random() < 0.1:
                calls.append((conv, f"c{n}", "search", search(7), None))
        results += [(conv, f"c{rng.randint(0, size + 1)}", rng.choice("xy"), None) for _ in range(size)]
    found = linked(spark, calls, results)
    expected = brute(calls, results)
    assert {key: (row.status, row.level) for key, row in found.items()} == expected
    assert {"ok", "cycle", "dangling", "duplicate", "invalid", "no_call", "no_result"} == {status for status, _ in expected.values()}
    assert max(level or 0 for _, level in expected.values()) >= 5


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    from odsflow.llm import tool_calls

    rounds, write = [], tool_calls.written
    monkeypatch.setattr(tool_calls, "written", lambda df, name: rounds.append(name) or write(df, name))
    calls = [(1, f"c{n}", "search", search(after=f"c{n - 1}" if n else None), None) for n in range(600)]
    # A cycle of three with a tail, beside the chain.
    calls += [(2, f"d{n}", "search", search(after=f"d{max(n - 1, 0) if n != 0 else 2}"), None) for n in range(9)]
    long = json.dumps({"query": "x" * 3_000_000, "limit": 1})
    calls.append((3, "long", "search", long, None))
    found = linked(spark, calls, [(3, "long", "y" * 3_000_000, None)])
    assert [found[1, f"c{n}"].level for n in range(600)] == list(range(600))
    assert {found[2, f"d{n}"].status for n in range(9)} == {"cycle"}
    assert found[3, "long"].status == "ok" and len(found[3, "long"].message) > 6_000_000
    assert rounds.count("chains") <= 11


def test_derived_from_turns(spark):
    turns = [(1, 0, "user", "what is it"), (1, 1, "assistant", "that"), (1, 2, "user", None), (1, 3, "assistant", None), (None, 0, "user", "x"), (2, 0, "system", "s")]
    calls, results = derived_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    found = link_calls(calls, results, SCHEMAS).collect()
    assert sorted((r.call_id, r.status) for r in found) == [
        ("call_0000000000", "no_identifier"), ("call_0000000000", "ok"), ("call_0000000002", "invalid"),
    ]


def test_turns_make_chains_and_cycles(spark):
    turns = [(1, n, "user" if n % 2 == 0 else "assistant", "word " * 4) for n in range(8)]
    turns += [(2, n, "user" if n % 2 == 0 else "assistant", "abc" if n == 2 else "word " * 4) for n in range(8)]
    calls, results = derived_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    found = {(r.conv_id, int(r.call_id[5:])): r for r in link_calls(calls, results, SCHEMAS).collect()}
    assert [found[1, n].level for n in (0, 2, 4, 6)] == [0, 1, 2, 3]
    assert [found[2, n].status for n in (0, 2, 4, 6)] == ["ok", "cycle", "cycle", "cycle"]
    assert json.loads(found[1, 4].message)["arguments"]["query"] == "word " * 4
