"""Tokens of two tokenizers over the same bytes, aligned where both end.

A is a byte-level BPE of the tokenizers library, B a SentencePiece model. Coarse cuts are the ends
that the libraries name: A's character offsets and the spans of B's immutable proto (called
``proto`` in this version of the library). Tokens that hold a part of a character, and B's byte
pieces, are refined by the bytes that tokens decode to. What lies between two cuts is a group; every
A token of a group is linked with every B token of it.

Texts are encoded in units that begin with a single space after a character that is no space:
neither tokenizer joins anything across such a place (A's pattern ends there, no piece of B holds a
space behind another character, which the loader checks). Equal units are encoded once while a task
remembers them.

Counting goes over batches of documents, not over documents: a batch has one row for each pair of ids
that it links, with the number of its documents. Sums of these rows are the corpus counts, which are
joined back to the batches. A frequent pair is one row per batch, which adaptive execution splits.
"""

from __future__ import annotations

import collections
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import table, written

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"

#: Places where texts may be cut: a space after no white space, and before anything.
CUT = re.compile(r"(?<=\S) (?=.)", re.DOTALL)
#: Characters of a long text that are split at once, of strings that are encoded at once and of units
#: that a task remembers.
BLOCK_CHARS = 1_000_000
ENCODE_CHARS = 100_000
KNOWN_CHARS = 6_000_000
#: Characters of documents whose units are learnt together.
AHEAD_CHARS = 500_000
#: Characters of a string of units that is encoded as one.
STRING_CHARS = 2_000
#: Links of a group from which equal pairs are put together at once.
LARGE_GROUP = 65_536
#: A batch ends when it has that many pairs (of all its documents together) or documents.
BATCH_PAIRS = 1_000_000
BATCH_DOCS = 20_000

_MARK = "▁"


def _byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Aligned:
    """Groups of some strings that were encoded together, as arrays over all their tokens.

    ``cuts`` are the byte ends of groups, ``a`` and ``b`` the ids, ``group_a`` and ``group_b`` the group of each token.
    """

    def __init__(self, cuts, a, b, group_a, group_b):
        self.cuts, self.a, self.b, self.group_a, self.group_b = cuts, a, b, group_a, group_b
        self.n_a, self.n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        self.start_a, self.start_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, pair of ids (A's in the upper half) and times of all links. Within a very large group, equal
        pairs are put together."""
        links = self.n_a * self.n_b
        large = np.flatnonzero(links > LARGE_GROUP)
        plain = links.copy()
        plain[large] = 0
        group = np.repeat(np.arange(len(links)), plain)
        inside = np.arange(len(group)) - np.repeat(np.cumsum(plain) - plain, plain)
        of_a = self.a[self.start_a[group] + inside // np.maximum(self.n_b[group], 1)]
        of_b = self.b[self.start_b[group] + inside % np.maximum(self.n_b[group], 1)]
        found = [(group, of_a << 32 | of_b, np.ones(len(group), np.int64))]
        for g in large.tolist():
            ids_a, often_a = np.unique(self.a[self.start_a[g] :][: self.n_a[g]], return_counts=True)
            ids_b, often_b = np.unique(self.b[self.start_b[g] :][: self.n_b[g]], return_counts=True)
            pairs = (ids_a[:, None] << 32 | ids_b[None, :]).ravel()
            found.append((np.full(len(pairs), g), pairs, (often_a[:, None] * often_b[None, :]).ravel()))
        group, pairs, times = (np.concatenate(x) for x in zip(*found))
        if len(large):
            order = np.argsort(group, kind="stable")
            group, pairs, times = group[order], pairs[order], times[order]
        return group, pairs, times


class Aligner:
    """Both tokenizers, and the groups of texts."""

    def __init__(self, model_a: str = MODEL_A, model_b: str = MODEL_B):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each task
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(model_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_b)
        alphabet = _byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab().items()}
        decoded = lambda t: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
        self.bytes_a = [decoded(names.get(i, "")) for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        is_byte = [self.b.is_byte(i) for i in range(len(pieces))]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if x else p.replace(_MARK, " ").encode() for p, x in zip(pieces, is_byte)]
        self.size_a, self.size_b = np.array(list(map(len, self.bytes_a))), np.array(list(map(len, self.bytes_b)))
        #: Ids as text with what follows them: more of the group, the other side, the next group.
        written = lambda n, end: np.array([f"{i}{end}" for i in range(n)], object)
        self.more_a, self.last_a = written(len(self.bytes_a), ","), written(len(self.bytes_a), "|")
        self.more_b, self.last_b = written(len(pieces), ","), written(len(pieces), ";")
        #: Whether no piece crosses a place of CUT.
        self.cuts = not any(_MARK in p.lstrip(_MARK) for p in pieces)

    def align(self, texts: list[str]) -> tuple[list[int], np.ndarray, Aligned | None]:
        """Aligns space+text of those texts (given by place) whose bytes both tokenizers keep, one after
        the other; ends of these texts in the bytes; their groups."""
        encoded = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        protos = self.b.encode(texts, return_type="proto", num_threads=1)
        kept, ids_a, ids_b, base, size = [], [], [], [], 0
        coarse_a, coarse_b = [], []
        for place, (text, a, b) in enumerate(zip(texts, encoded, protos)):
            data, pieces = (" " + text).encode(), b.pieces
            own_a, own_b = a.ids, [p.id for p in pieces]
            if not text or b"".join([self.bytes_a[i] for i in own_a]) != data or b"".join([self.bytes_b[i] for i in own_b]) != data:
                continue
            # Ends that the libraries name: characters of A, bytes of the text without the space of B.
            ends = np.fromiter([end for _, end in a.offsets], np.int64, len(own_a))
            coarse_a.append((ends if len(data) == len(text) + 1 else _byte_places(" " + text)[ends]) + size)
            coarse_b.append(np.fromiter([p.end for p in pieces], np.int64, len(own_b)) + (1 + size))
            kept.append(place)
            ids_a += own_a
            ids_b += own_b
            size += len(data)
            base.append(size)
        if not kept:
            return kept, np.empty(0, np.int64), None
        a, b = np.array(ids_a), np.array(ids_b)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # Coarse cuts; an end inside a character or among byte pieces is none if no decoded token ends there.
        cuts = np.concatenate(coarse_a)
        cuts = cuts[_among(cuts, np.concatenate(coarse_b)) & _among(cuts, ends_a) & _among(cuts, ends_b)]
        cuts = cuts[np.append(cuts[1:] != cuts[:-1], True)]
        # What lies between two of them is refined by decoded bytes where both sides have several tokens.
        in_a, in_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        open_ = (np.bincount(in_a, minlength=len(cuts) + 1) > 1) & (np.bincount(in_b, minlength=len(cuts) + 1) > 1)
        refined, against = ends_a[open_[in_a]], ends_b[open_[in_b]]
        if len(refined):
            refined = refined[_among(refined, against)]
            cuts = np.concatenate([cuts, refined[~_among(refined, cuts)]])
            cuts.sort()
            in_a, in_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        return kept, np.array(base), Aligned(cuts, a, b, in_a, in_b)

    def groups(self, text: str | None) -> list[tuple[int, int, list[int], list[int]]]:
        """Groups (start, end, ids of A, ids of B) of the bytes of space+text; empty where it has no tokens."""
        found = self.align([text])[2] if text else None
        if found is None:
            return []
        starts = [0, *found.cuts[:-1].tolist()]
        sides = [np.split(ids, np.cumsum(n)[:-1]) for ids, n in ((found.a, found.n_a), (found.b, found.n_b))]
        return [(start, end, a.tolist(), b.tolist()) for start, end, a, b in zip(starts, found.cuts.tolist(), *sides)]


def _among(values: np.ndarray, sorted_ones: np.ndarray) -> np.ndarray:
    """Which values are among those of an ascending array."""
    if not len(sorted_ones):
        return np.zeros(len(values), bool)
    return sorted_ones[np.minimum(np.searchsorted(sorted_ones, values), len(sorted_ones) - 1)] == values


def _byte_places(text: str) -> np.ndarray:
    """Byte at which each character begins, and where the last one ends."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    sizes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    return np.concatenate([[0], np.cumsum(sizes)])


class _Growing:
    """Rows that are added again and again, in one array."""

    def __init__(self, width: int | None = None):
        self.rows = np.empty(1024 if width is None else (1024, width), np.int64)
        self.size = 0

    def add(self, rows: np.ndarray) -> None:
        if self.size + len(rows) > len(self.rows):
            more = np.empty((max(len(self.rows) * 2, self.size + len(rows)), *self.rows.shape[1:]), np.int64)
            more[: self.size] = self.rows[: self.size]
            self.rows = more
        self.rows[self.size : self.size + len(rows)] = rows
        self.size += len(rows)


class Units:
    """What a task remembers of units: figures, the text of their groups and the pairs they link."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.text: dict[str, str | None] = {}
        self.figures = _Growing(6)  # those of a document, then where the pairs start and how many there are
        self.pairs, self.times = _Growing(), _Growing()
        self.chars = 0

    def learn(self, units: list[str]) -> None:
        """Units go to the tokenizers in strings of many, as they are cut where nothing is joined."""
        strings, alone, held, chars = [], [], [], 0
        for unit in units:
            if not self.aligner.cuts or _MARK in unit or unit[-1:].isspace() or len(unit) > STRING_CHARS:
                alone.append([unit])
                continue
            held.append(unit)
            chars += len(unit) + 1
            if chars > STRING_CHARS:
                strings.append(held)
                held, chars = [], 0
        strings += [held] if held else []
        again = self._learn(strings + alone)
        again = self._learn([[unit] for string in again for unit in string if len(string) > 1])
        assert not again

    def _learn(self, strings: list[list[str]]) -> list[list[str]]:
        """Those strings that have to be taken unit by unit."""
        again, start = [], 0
        while start < len(strings):
            end, chars = start, 0
            while end < len(strings) and (end == start or chars < ENCODE_CHARS):
                chars += sum(map(len, strings[end]))
                end += 1
            part = strings[start:end]
            kept, ends, found = self.aligner.align([" ".join(s) for s in part])
            chosen = set(kept)
            for place, string in enumerate(part):
                if place not in chosen and len(string) > 1:
                    again.append(string)
                elif place not in chosen:
                    self._note([string[0]], [None], np.zeros((1, 4), np.int64), np.zeros(1, np.int64))
            if found is not None:
                again += self._add([part[k] for k in kept], ends, found)
            start = end
        return again

    def _add(self, strings: list[list[str]], ends: np.ndarray, found: Aligned) -> list[list[str]]:
        units = [unit for string in strings for unit in string]
        unit_ends = np.cumsum([len(unit.encode()) + 1 for unit in units])
        if not _among(unit_ends, found.cuts).all():  # something is joined across units after all
            if all(len(string) == 1 for string in strings):
                raise ValueError("the bytes of a text and of its tokens differ")
            return strings
        unit = np.searchsorted(unit_ends, found.cuts)
        figures = np.zeros((len(units), 4), np.int64)
        for column, values in enumerate((found.n_a, found.n_b, np.ones(len(unit), np.int64), found.n_a * found.n_b)):
            figures[:, column] = np.bincount(unit, values, len(units))
        group, pairs, times = found.links()
        al, last = self.aligner, lambda g: np.append(g[1:] != g[:-1], True)
        texts_a = np.where(last(found.group_a), al.last_a[found.a], al.more_a[found.a])
        texts_b = np.where(last(found.group_b), al.last_b[found.b], al.more_b[found.b])
        order = np.argsort(np.concatenate([found.group_a * 2, found.group_b * 2 + 1]), kind="stable")
        texts = np.concatenate([texts_a, texts_b])[order].tolist()
        bounds = [0, *np.cumsum(figures[:, 0] + figures[:, 1]).tolist()]
        joined = ["".join(texts[s:e])[:-1] for s, e in zip(bounds, bounds[1:])]
        self.pairs.add(pairs)
        self.times.add(times)
        self._note(units, joined, figures, np.bincount(unit[group], minlength=len(units)))
        return []

    def _note(self, units: list[str], texts: list[str | None], figures: np.ndarray, n_pairs: np.ndarray) -> None:
        first = self.pairs.size - int(n_pairs.sum())
        starts = first + np.cumsum(n_pairs) - n_pairs
        self.number.update(zip(units, range(self.figures.size, self.figures.size + len(units))))
        self.text.update(zip(units, texts))
        self.figures.add(np.column_stack([figures, starts, n_pairs]))
        self.chars += sum(map(len, units))


def _blocks(text: str) -> Iterator[list[str]]:
    """The units of a text without their first space, some at a time."""
    start = 0
    while len(text) - start > BLOCK_CHARS and (cut := CUT.search(text, start + BLOCK_CHARS)):
        yield CUT.split(text[start : cut.start()])
        start = cut.end()
    yield CUT.split(text[start:])


def _summed(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their weights."""
    flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
    if not len(flat):
        return flat, flat
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    return flat[starts], np.add.reduceat(np.concatenate(weights)[order], starts)


_NOTHING = (np.zeros(4, np.int64), "", *_summed([], []))


def _split(texts: list[str | None], known: Units) -> list[list[str] | None]:
    """Units of those texts that are not split in blocks, all learnt at once."""
    if known.chars > KNOWN_CHARS:
        known.clear()
    short = [CUT.split(t) if t and len(t) <= BLOCK_CHARS and known.aligner.cuts else None for t in texts]
    new = {unit: None for units in short if units for unit in units if unit not in known.number}
    known.learn(list(new))
    return short


def _document(text: str | None, known: Units, split: list[str] | None = None):
    """Figures, digest of the groups, linked pairs and how often each is linked. ``split`` are units of the text
    that are known already."""
    if not text:
        return _NOTHING
    figures, digest, pairs, times, more = np.zeros(4, np.int64), hashlib.sha256(), [], [], False
    for units in [split] if split else _blocks(text) if known.aligner.cuts else [[text]]:
        if known.chars > KNOWN_CHARS and not split:
            known.clear()
        counts = collections.Counter(units)
        if not split and (new := [u for u in counts if u not in known.number]):
            known.learn(new)
        texts = list(map(known.text.__getitem__, units))
        if None in texts:
            # Bytes of a part differ; the whole text decides.
            if len(units) > 1 or more or len(units[0]) < len(text):
                return _whole(text, known.aligner)
            return _NOTHING
        digest.update((";" * more + ";".join(texts)).encode())
        more = True
        rows = known.figures.rows[np.fromiter(map(known.number.__getitem__, counts), np.int64, len(counts))]
        often = np.fromiter(counts.values(), np.int64, len(counts))
        figures = figures + often @ rows[:, :4]
        starts, n_pairs = rows[:, 4], rows[:, 5]
        at = np.arange(n_pairs.sum()) + np.repeat(starts - np.cumsum(n_pairs) + n_pairs, n_pairs)
        pairs.append(known.pairs.rows[at])
        times.append(known.times.rows[at] * np.repeat(often, n_pairs))
        if len(pairs) > 8:
            one = _summed(pairs, times)
            pairs, times = [one[0]], [one[1]]
    return figures, digest.hexdigest(), *_summed(pairs, times)


def _whole(text: str, aligner: Aligner):
    """A text as a single unit."""
    alone = Units(aligner)
    alone._learn([[text]])
    if alone.text[text] is None:
        return _NOTHING
    digest = hashlib.sha256(alone.text[text].encode()).hexdigest()
    return alone.figures.rows[0, :4], digest, *_summed([alone.pairs.rows[: alone.pairs.size]], [alone.times.rows[: alone.times.size]])


_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
_STAGE = "batch bigint, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<int>, times array<int>, ids_a array<int>, ids_b array<int>, docs array<int>"
_STAGE_ARROW = pa.schema(
    [("batch", pa.int64()), ("id", pa.int64()), *[(c, pa.int64()) for c in _FIGURES], ("groups_sha256", pa.string())]
    + [(c, pa.list_(pa.int32())) for c in ("pairs", "times", "ids_a", "ids_b", "docs")]
)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def _batch(number: int, ids: list, found: list) -> Iterator[pa.RecordBatch]:
    """Rows of the documents of a batch, then the row of its pairs (whose ``times`` is null)."""
    pairs, where = np.unique(np.concatenate([f[2] for f in found]), return_inverse=True)
    docs = np.bincount(where, minlength=len(pairs))
    places, at = [], 0
    for f in found:
        places.append(where[at : at + len(f[2])])
        at += len(f[2])
    figures = np.array([f[0] for f in found], np.int64).reshape(len(found), 4)
    none = pa.nulls(len(found), pa.list_(pa.int32()))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(found), number)), pa.array(ids, pa.int64()), *map(pa.array, figures.T.copy()), pa.array([f[1] for f in found], pa.string())]
        + [_lists(places), _lists([f[3] for f in found]), none, none, none],
        schema=_STAGE_ARROW,
    )
    if len(pairs):
        empty = [pa.nulls(1, pa.int64())] * 5 + [pa.nulls(1, pa.string())] + [pa.nulls(1, pa.list_(pa.int32()))] * 2
        lists = [_lists([pairs >> 32]), _lists([pairs & 0xFFFFFFFF]), _lists([docs])]
        yield pa.RecordBatch.from_arrays([pa.array([number]), *empty, *lists], schema=_STAGE_ARROW)


def _ahead(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Ids and texts of some documents at a time."""
    ids, texts, chars = [], [], 0
    for id_, text in zip(batch["id"], batch["text"]):
        ids.append(id_.as_py())
        texts.append(text.as_py())
        chars += len(texts[-1] or "")
        if chars >= AHEAD_CHARS:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def _encoded(batches, model_a: str, model_b: str) -> Iterator[pa.RecordBatch]:
    known, ids, found, size = None, [], [], 0
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        known = known or Units(Aligner(model_a, model_b))
        for some_ids, texts in _ahead(batch):
            for id_, text, split in zip(some_ids, texts, _split(texts, known)):
                ids.append(id_)
                found.append(_document(text, known, split))
                size += len(found[-1][2])
                if size >= BATCH_PAIRS or len(ids) >= BATCH_DOCS:
                    yield from _batch(number, ids, found)
                    number, ids, found, size = number + 1, [], [], 0
    if ids:
        yield from _batch(number, ids, found)


_OUT = f"id bigint, {', '.join(f'{c} bigint' for c in _FIGURES)}, n_best bigint, count_sum bigint, groups_sha256 string"


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Rows of one batch with what the corpus counts of its pairs give."""
    place = counts.column("place").to_numpy()
    n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    n[place], best[place] = counts.column("n").to_numpy(), counts.column("best").to_numpy()
    lists, often = docs.column("pairs").combine_chunks(), docs.column("times").combine_chunks()
    where, times = lists.flatten().to_numpy(), often.flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(docs)), lists.value_lengths().to_numpy())
    total, top = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    np.add.at(total, owner, n[where] * times)
    np.add.at(top, owner, (n == best)[where] * times)
    columns = [docs.column("id"), *[docs.column(c) for c in _FIGURES], pa.array(top), pa.array(total), docs.column("groups_sha256")]
    return pa.Table.from_arrays(columns, names=["id", *_FIGURES, "n_best", "count_sum", "groups_sha256"])


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """Rows (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every document.

    The count of a pair of ids is the number of documents that hold it linked. ``n_best`` are the
    links whose count is the highest of their A id, ties included; ``count_sum`` adds the
    counts of all links. Texts that are null or empty, or whose tokens' bytes are not those of
    space+text, have zeros and an empty digest. Repeated rows count as documents of their own; a
    null id stays null; an empty table gives no rows. Other columns do not pass.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    stage = written(source.mapInArrow(lambda batches: _encoded(batches, model_a, model_b), _STAGE), "alignment")
    pairs = stage.where(F.col("times").isNull()).select("batch", F.posexplode(F.arrays_zip("ids_a", "ids_b", "docs")).alias("place", "p"))
    pairs = pairs.select("batch", "place", F.col("p.ids_a").alias("a"), F.col("p.ids_b").alias("b"), F.col("p.docs").alias("docs"))
    counts = written(pairs.groupBy("a", "b").agg(F.sum("docs").alias("n")), "alignment-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("best"))
    counts = counts.join(highest, "a")
    wanted = pairs.join(counts, ["a", "b"]).select(F.col("batch").alias("of"), "place", "n", "best")
    each = stage.where(F.col("times").isNotNull()).select("batch", "id", *_FIGURES, "groups_sha256", "pairs", "times")
    return each.groupBy("batch").cogroup(wanted.groupBy("of")).applyInArrow(_scored, _OUT)


_GROUPS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("a", T.ArrayType(T.IntegerType())), T.StructField("b", T.ArrayType(T.IntegerType()))]))


def spans(docs: DataFrame, keep: list[str], text_col: str = "text", model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """Columns ``keep`` and ``groups``: start and end in the bytes of space+text, ids of A, ids of B."""
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("groups", _GROUPS)])

    def aligned(batches):
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(model_a, model_b)
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                groups = [dict(zip(("start", "end", "a", "b"), g)) for g in aligner.groups(one["__text"][0].as_py())]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
                yield pa.RecordBatch.from_arrays([*one.columns[:-1], pa.array([groups], kind)], names=[*keep, "groups"])

    return source.mapInArrow(aligned, schema)


def op13_tokenizer_spans(spark, sf_dir: str) -> DataFrame:
    """Alignment of all ``documents``."""
    return scored(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
