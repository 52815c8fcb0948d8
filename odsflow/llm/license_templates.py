"""Licence notices and texts found by templates with optional and replaceable regions.

A template is wording in which ``<<beginOptional>>...<<endOptional>>`` may be left out and
``<<var;words=n>>`` stands for up to ``n`` words of any kind. All templates are compiled into one
token automaton, which is made deterministic while it runs; a text is accepted where the mandatory
wording stands word by word (case, punctuation and line breaks do not count).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import slices, table, words

# Phrases that the base rule looks for, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Public licence notices and texts, with the regions that may differ.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0<<beginOptional>> (the \"License\"); you may not use this file "
        "except in compliance with the License<<endOptional>>"
    ),
    "cc-by-4.0": "licensed under <<beginOptional>>a <<endOptional>>CC BY 4.0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a <<endOptional>>CC BY-NC 4.0",
    "cc-by-sa-4.0": "licensed under <<beginOptional>>a <<endOptional>>CC BY-SA 4.0",
    "gpl-3.0": (
        "<<var;words=3>> licensed under the <<beginOptional>>terms of the <<endOptional>>GNU General Public License, "
        "version 3"
    ),
    "gpl-notice": (
        "This program is free software<<beginOptional>>: you can redistribute it and/or modify it<<endOptional>> under "
        "the terms of the GNU General Public License as published by the Free Software Foundation"
    ),
    "isc": (
        "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any "
        "purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "mit-notice": "Released under the <<beginOptional>>terms of the <<endOptional>>MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice<<beginOptional>> (including the next "
        "paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "<<var;words=12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY"
    ),
    "spdx-mit": "SPDX-License-Identifier: MIT",
}

_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+))>>")


def parse(template: str) -> list:
    """A template as a list of words, ``int`` (a replaceable region) and lists (optional regions)."""
    stack, last = [[]], 0
    for mark in [*_MARK.finditer(template), None]:
        stack[-1] += words(template[last : mark.start() if mark else len(template)])
        if mark is None:
            break
        last = mark.end()
        if mark[1] == "beginOptional":
            stack.append([])
        elif mark[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without beginOptional")
            region = stack.pop()
            stack[-1].append(region)
        else:
            stack[-1].append(int(mark[2]))
    if len(stack) > 1:
        raise ValueError("beginOptional without endOptional")
    return stack[0]


class Automaton:
    """All templates in one automaton over words, searched at every word of a text.

    ``step[state]`` leads from a word to the next state, and from None for all words that no
    template holds; states are made when they are first reached.
    """

    def __init__(self, templates: dict[str, list]):
        self.labels = list(templates)
        self.word: list[dict[bytes, set[int]]] = []
        self.free: list[set[int]] = []  # next nodes without a word
        self.any: list[int | None] = []
        self.accepts: dict[int, int] = {}
        self.starts = []
        for number, parts in enumerate(templates.values()):
            start = self._node()
            self.starts.append(start)
            self.accepts[self._chain(parts, start)] = number
        self.vocabulary = {w for node in self.word for w in node}
        self.start = self._closure(self.starts)
        self.ids = {self.start: 0}
        self.nodes = [self.start]
        self.step: list[dict] = [{}]
        self.found: list[tuple[int, ...]] = [self._accepted(self.start)]

    def _node(self) -> int:
        self.word.append({})
        self.free.append(set())
        self.any.append(None)
        return len(self.word) - 1

    def _chain(self, parts: list, here: int) -> int:
        for part in parts:
            if isinstance(part, list):
                end = self._chain(part, here)
                self.free[here].add(end)
                here = end
            elif isinstance(part, int):
                end = self._node()
                self.free[here].add(end)
                for _ in range(part):
                    following = self._node()
                    self.any[here] = following
                    self.free[following].add(end)
                    here = following
                here = end
            else:
                following = self._node()
                self.word[here].setdefault(part, set()).add(following)
                here = following
        return here

    def _closure(self, nodes) -> frozenset[int]:
        reached, todo = set(nodes), list(nodes)
        while todo:
            for following in self.free[todo.pop()]:
                if following not in reached:
                    reached.add(following)
                    todo.append(following)
        return frozenset(reached)

    def _accepted(self, nodes) -> tuple[int, ...]:
        return tuple(sorted(self.accepts[n] for n in nodes if n in self.accepts))

    def _after(self, nodes, word: bytes | None) -> set[int]:
        following = {self.any[n] for n in nodes if self.any[n] is not None}
        for n in nodes:
            following |= self.word[n].get(word, set())
        return following

    def move(self, state: int, word: bytes | None) -> int:
        """The state after one more word; a match may begin at any word."""
        nodes = self._closure(self._after(self.nodes[state], word)) | self.start
        if nodes not in self.ids:
            self.ids[nodes] = len(self.nodes)
            self.nodes.append(nodes)
            self.step.append({})
            self.found.append(self._accepted(nodes))
        self.step[state][word] = self.ids[nodes]
        return self.ids[nodes]

    def ends(self, text: list[bytes]) -> list[tuple[int, int]]:
        """(word after the end, template) of all accepted places."""
        step, found, vocabulary = self.step, self.found, self.vocabulary
        state, out = 0, []
        for place, word in enumerate(text, 1):
            if word not in vocabulary:
                if not state and None in step[0]:
                    state = step[0][None]
                    continue
                word = None
            following = step[state].get(word)
            state = self.move(state, word) if following is None else following
            if found[state]:
                out += [(place, number) for number in found[state]]
        return out

    def longest(self, text: list[bytes], begin: int, number: int) -> int | None:
        """Where the longest place of a template that begins at a word ends; None if none does."""
        nodes, end = self._closure([self.starts[number]]), None
        for place in range(begin, len(text) + 1):
            if any(self.accepts.get(n) == number for n in nodes):
                end = place
            if place == len(text) or not nodes:
                break
            nodes = self._closure(self._after(nodes, text[place]))
        return end

    def first_words(self, number: int) -> set[bytes] | None:
        """Words that a place of a template can begin with; None when any word can be first."""
        nodes = self._closure([self.starts[number]])
        return None if any(self.any[n] is not None for n in nodes) else {w for n in nodes for w in self.word[n]}

    def length(self, number: int) -> int:
        """Most words of a place of a template."""
        deepest, layer = 0, {self.starts[number]}
        while layer:
            layer = self._closure(layer)
            layer = {n for node in layer for n in [self.any[node], *(x for s in self.word[node].values() for x in s)] if n is not None}
            deepest += bool(layer)
        return deepest


def scan(docs: DataFrame, keep: list[str], phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Rows (``keep``, ``lt_words``, ``lt_phrases``, ``lt_templates``) for every row of ``docs``.

    ``lt_words`` is the number of words, ``lt_phrases`` the base phrases found (label, first word,
    all places), ``lt_templates`` the accepted templates (label, first word, word after the last;
    a place inside a longer one of the same template is left out). A null or empty text has none.
    Columns of these names in ``docs`` are replaced.
    """
    place = T.StructType(
        [T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    )
    added = T.StructType(
        [
            T.StructField("lt_words", T.LongType()),
            T.StructField("lt_phrases", T.ArrayType(place)),
            T.StructField("lt_templates", T.ArrayType(place)),
        ]
    )
    keep = [c for c in keep if c not in added.fieldNames()]
    frame = docs.select([f"`{c}`" for c in dict.fromkeys([*keep, "text"])])
    schema = T.StructType([f for f in frame.schema.fields if f.name in keep] + added.fields)
    compiled = {f"p{label}": words(phrase) for phrase, label in phrases.items()}
    compiled |= {f"t{label}": parse(template) for label, template in templates.items()}
    if any(not part for part in compiled.values()):
        raise ValueError("a phrase or template has no words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(compiled)
        names = automaton.labels
        sizes = [automaton.length(i) for i in range(len(names))]
        heads = [automaton.first_words(i) for i in range(len(names))]
        arrow = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches, 2000):
            counts, bases, fulls = [], [], []
            for text in batch.column("text").to_pylist():
                split = words(text)
                base, full = [], {}
                for end, number in automaton.ends(split):
                    label = names[number]
                    if label[0] == "p":
                        base.append((label[1:], end - sizes[number], end))
                        continue
                    # The earliest beginning from which the template reaches this end.
                    for begin in range(max(0, end - sizes[number]), end):
                        if heads[number] is None or split[begin] in heads[number]:
                            last = automaton.longest(split, begin, number)
                            if last is not None and last >= end:
                                old = full.get((label, last))
                                full[(label, last)] = begin if old is None else min(old, begin)
                                break
                counts.append(len(split))
                bases.append([{"label": a, "start": b, "end": c} for a, b, c in sorted(base, key=lambda p: (p[1], p[0]))])
                spans = sorted((begin, label[1:], end) for (label, end), begin in full.items())
                fulls.append([{"label": b, "start": a, "end": c} for a, b, c in outermost(spans)])
            kept = [batch.column(c) for c in batch.schema.names if c in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts, pa.int64()), pa.array(bases, arrow), pa.array(fulls, arrow)],
                names=[*(c for c in batch.schema.names if c in keep), *added.fieldNames()],
            )

    return frame.mapInArrow(run, schema)


def outermost(spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Different (start, label, end) without those that lie inside another of their label, in order."""
    kept, reach = [], {}
    for start, label, end in sorted(spans, key=lambda s: (s[0], -s[2])):
        # All of the label that begin no later are done; the longest of them decides.
        if end > reach.get(label, -1):
            kept.append((start, label, end))
            reach[label] = end
    return sorted(kept)


def op2_license_templates(spark, sf_dir: str) -> DataFrame:
    """Base phrases and accepted templates of every row of ``documents``.

    ``score`` is 1 where a template is accepted, 0.5 where only a base phrase stands, else 0.
    """
    found = scan(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.array_distinct(F.col("lt_phrases.label"))
    full = F.array_distinct(F.col("lt_templates.label"))
    return found.select(
        "doc_id",
        F.col("lt_words").alias("n_words"),
        F.size("lt_phrases").cast("long").alias("n_base"),
        F.array_min("lt_phrases.start").alias("first_word"),
        F.array_max("lt_phrases.start").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, full)), ",").alias("labels"),
        F.when(F.size("lt_templates") > 0, 1.0).when(F.size("lt_phrases") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def _pattern(parts: list) -> str:
    """A template as a pattern over words that each stand between two blanks."""
    out = ""
    for part in parts:
        if isinstance(part, list):
            out += f"(?:{_pattern(part)})?"
        elif isinstance(part, int):
            out += f"(?: [^ ]+ ){{0,{part}}}"
        else:
            out += f" {part.decode()} "
    return out


def _sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    places, cases = [], []
    for phrase, label in PHRASES.items():
        at = " AND ".join(f"w[i + {j}] = '{word}'" for j, word in enumerate(phrase.split(), 1))
        places.append(f"list_filter(range(len(w)), lambda i: coalesce({at}, false)) AS at_{label}")
        cases.append(f"CASE WHEN len(at_{label}) > 0 THEN '{label}' END")
    union = "list_concat(" + ", ".join(f"at_{label}" for label in PHRASES.values()) + ")"
    for label, template in TEMPLATES.items():
        pattern = _pattern(parse(template))
        cases.append(f"CASE WHEN regexp_matches(j, '{pattern}') THEN '{label}' END")
    base = ", ".join(cases[: len(PHRASES)])
    return f"""
WITH split AS (
    SELECT doc_id, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
found AS (SELECT doc_id, w, ' ' || array_to_string(w, '  ') || ' ' AS j, {", ".join(places)} FROM split),
named AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, {union} AS places,
        list_sort(list_filter([{base}], lambda x: x IS NOT NULL)) AS base,
        list_filter([{", ".join(cases[len(PHRASES):])}], lambda x: x IS NOT NULL) AS full_labels
    FROM found)
SELECT doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
    list_max(places)::BIGINT AS last_word, array_to_string(base, ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(base, full_labels))), ',') AS labels,
    CASE WHEN len(full_labels) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM named
"""


SQL = _sql()
