"""Encoding and decoding with a SentencePiece BPE model by suffix-array matching.

The different words of a batch are concatenated and indexed by a suffix array; every piece of the
vocabulary is found by binary search as a range of it, which gives all edges (place, piece) at
once. Edges are sorted into a table by place and length, and all words are relaxed together: in
each round every word joins the two neighbouring parts whose edge has the best score (the first
one among equals) until no edge joins any two; this is what the scores of a BPE model mean.
Characters without a piece become their bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import slices, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of different words that are indexed at once.
CHUNK_CHARS = 200_000
#: Different words that a task remembers.
KNOWN_WORDS = 150_000
#: Longer words are relaxed one by one with a queue.
LONG_WORD = 256

_MARK = "▁"
_UNITS = re.compile(f"{_MARK}+[^{_MARK}]*")


class Model:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=path)
        size = loaded.vocab_size()
        special = [loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i) for i in range(size)]
        is_byte = [loaded.is_byte(i) for i in range(size)]
        names = [loaded.id_to_piece(i) for i in range(size)]
        self.byte = np.full(256, loaded.unk_id(), np.int32)
        self.decoded: list[bytes] = []
        for i, name in enumerate(names):
            if is_byte[i]:
                self.byte[int(name[1:-1], 16)] = i
                self.decoded.append(bytes([int(name[1:-1], 16)]))
            else:
                self.decoded.append(b"" if special[i] else name.replace(_MARK, " ").encode())
        self.ids = np.array([i for i in range(size) if not special[i] and not is_byte[i]], np.int64)
        plain = [names[i] for i in self.ids]
        self.longest = max(map(len, plain))
        self.length = np.array([len(p) for p in plain], np.int64)
        self.codes = np.zeros((len(plain), self.longest), np.uint32)
        for row, piece in enumerate(plain):
            self.codes[row, : len(piece)] = [ord(c) for c in piece]
        scores = np.array([loaded.get_score(int(i)) for i in self.ids])
        self.rank = np.full(size, np.iinfo(np.int32).max, np.int64)
        self.rank[self.ids] = np.unique(-scores, return_inverse=True)[1]

    def decode(self, ids: list[int]) -> str:
        data = b"".join([self.decoded[i] for i in ids])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _bisect(keys: list[np.ndarray], sought: list[np.ndarray], right: bool) -> np.ndarray:
    """Places of the sought rows of keys in sorted rows of keys, all searched together."""
    low = np.zeros(len(sought[0]), np.int64)
    high = np.full(len(sought[0]), len(keys[0]), np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = np.minimum((low + high) // 2, len(keys[0]) - 1)
        less = np.zeros(len(low), bool)
        same = np.ones(len(low), bool)
        for key, value in zip(keys, sought):
            here = key[middle]
            less |= same & (here < value)
            same &= here == value
        go = (less | same) if right else less
        low = np.where(open_ & go, middle + 1, low)
        high = np.where(open_ & ~go, middle, high)


def _edges(codes: np.ndarray, model: Model) -> np.ndarray:
    """Table (place, length) of piece ids + 1 that stand at each place; 0 where none does.

    ``codes`` are code points; 0 stands between words.
    """
    present, inverse = np.unique(codes, return_inverse=True)
    known = np.isin(present, np.unique(model.codes)) & (present > 0)
    number = np.where(known, np.cumsum(known), 0)
    symbols = number[inverse].astype(np.int64)
    width = max(1, int(known.sum()).bit_length())
    at = np.minimum(np.searchsorted(present, model.codes), len(present) - 1)
    pieces = np.where(present[at] == model.codes, number[at], 0)
    inside = np.arange(model.longest)[None, :] < model.length[:, None]
    usable = np.flatnonzero(((pieces > 0) | ~inside).all(axis=1))
    pieces, inside = pieces[usable], inside[usable]
    per_key = 62 // width
    padded = np.concatenate([symbols, np.zeros(model.longest + per_key, np.int64)])
    keys, first, last = [], [], []
    for start in range(0, model.longest, per_key):
        key = np.zeros(len(codes), np.int64)
        least, most = np.zeros(len(usable), np.int64), np.zeros(len(usable), np.int64)
        for j in range(start, start + per_key):
            key = (key << width) | padded[j : j + len(codes)]
            there = inside[:, j] if j < model.longest else np.zeros(len(usable), bool)
            symbol = pieces[:, j] if j < model.longest else 0
            least = (least << width) | np.where(there, symbol, 0)
            most = (most << width) | np.where(there, symbol, (1 << width) - 1)
        keys.append(key)
        first.append(least)
        last.append(most)
    order = np.lexsort(keys[::-1])
    keys = [key[order] for key in keys]
    low, high = _bisect(keys, first, False), _bisect(keys, last, True)
    counts = high - low
    owner = np.repeat(np.arange(len(usable)), counts)
    place = order[np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + low[owner]]
    out = np.zeros((len(codes) + 1) * (model.longest + 1), np.int32)
    out[place * (model.longest + 1) + model.length[usable[owner]]] = model.ids[usable[owner]] + 1
    return out


def _relax(start: np.ndarray, word: np.ndarray, end: np.ndarray, edges: np.ndarray, model: Model):
    """Parts (start, end) that remain when all words have joined what they can.

    ``start`` and ``end`` are the characters of all words, ``word`` the word of each, in order.
    """
    none, row = np.iinfo(np.int64).max, model.longest + 1
    done_start, done_end = [start[:0]], [end[:0]]
    while len(start):
        length = np.zeros(len(start), np.int64)
        length[:-1] = end[1:] - start[:-1]
        joins = np.zeros(len(start), bool)
        joins[:-1] = (word[1:] == word[:-1]) & (length[:-1] <= model.longest)
        edge = np.where(joins, edges[start * row + np.minimum(length, model.longest)], 0)
        best = np.where(edge > 0, model.rank[edge - 1] * len(start) + np.arange(len(start)), none)
        head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        least = np.minimum.reduceat(best, head)
        size = np.diff(np.append(head, len(start)))
        over = np.repeat(least == none, size)
        done_start.append(start[over])
        done_end.append(end[over])
        left = least[least != none] % len(start)
        end[left] = end[left + 1]
        keep = ~over
        keep[left + 1] = False
        start, end, word = start[keep], end[keep], word[keep]
    start, end = np.concatenate(done_start), np.concatenate(done_end)
    order = np.argsort(start, kind="stable")
    return start[order], end[order]


def _relax_long(begin: int, finish: int, edges: np.ndarray, model: Model) -> list[tuple[int, int]]:
    """The same for one long word, with a queue of joins."""
    import heapq

    row = model.longest + 1
    following = {i: i + 1 for i in range(begin, finish)}
    before = {i: i - 1 for i in range(begin + 1, finish)}

    def offer(a: int):
        b = following.get(a, finish)
        if b < finish and following[b] - a <= model.longest:
            edge = int(edges[a * row + following[b] - a])
            if edge:
                heapq.heappush(queue, (int(model.rank[edge - 1]), a, b, following[b]))

    queue: list[tuple[int, int, int, int]] = []
    for i in range(begin, finish):
        offer(i)
    while queue:
        _, a, b, c = heapq.heappop(queue)
        if following.get(a) != b or following.get(b) != c:
            continue
        following[a] = c
        del following[b]
        if c < finish:
            before[c] = a
        offer(a)
        if a in before:
            offer(before[a])
    return sorted(following.items())


def encode_words(units: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words (the mark in front included), and how many belong to each."""
    if not units:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    size = np.array([len(u) for u in units], np.int64)
    first = np.cumsum(size + 1) - size - 1
    codes = np.frombuffer("\0".join(units).encode("utf-32-le") + b"\0\0\0\0", np.uint32)
    edges = _edges(codes, model)
    row = model.longest + 1
    place = np.arange(len(codes))
    word = np.repeat(np.arange(len(units)), size + 1)
    real = np.ones(len(codes), bool)
    real[first + size] = False
    long = np.repeat(size > LONG_WORD, size + 1)
    short = place[real & ~long]
    start, end = _relax(short, word[short], short + 1, edges, model)
    more = [pair for w in np.flatnonzero(size > LONG_WORD) for pair in _relax_long(int(first[w]), int(first[w] + size[w]), edges, model)]
    if more:
        extra = np.array(more, np.int64)
        start, end = np.concatenate([start, extra[:, 0]]), np.concatenate([end, extra[:, 1]])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
    ids = edges[start * row + (end - start)].astype(np.int64) - 1
    missing = np.flatnonzero(ids < 0)
    counts = np.ones(len(ids), np.int64)
    spelled = [chr(codes[start[i]]).encode("utf-8", "replace") for i in missing]
    counts[missing] = [len(s) for s in spelled]
    out = np.repeat(ids, counts).astype(np.int32)
    if spelled:
        at = (np.cumsum(counts) - counts)[missing]
        for offset, text in zip(at.tolist(), spelled):
            out[offset : offset + len(text)] = model.byte[list(text)]
    per_word = np.bincount(word[start], weights=counts, minlength=len(units)).astype(np.int64)
    return out, per_word


class Encoder:
    """Encodes texts; words are encoded once and remembered."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self):
        self.number: dict[str, int] = {}
        self.ids, self.first = np.empty(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many belong to each; null and empty texts have none."""
        if len(self.number) > KNOWN_WORDS:
            self._clear()
        number, places, sizes = self.number, [], []
        known = len(number)
        for text in texts:
            if not text:
                sizes.append(0)
                continue
            text = text.replace(_MARK, " ")
            if text[0] == " " or text[-1] == " " or "  " in text:
                units = [u[1:] for u in _UNITS.findall(_MARK + text.replace(" ", _MARK))]
            else:
                units = text.split(" ")
            sizes.append(len(units))
            places.append(np.array([number.setdefault(u, len(number)) for u in units], np.int64))
        self._learn(list(number)[known:] if len(number) > known else [])
        word = np.concatenate(places) if places else np.empty(0, np.int64)
        counts = (self.first[1:] - self.first[:-1])[word]
        ends = np.cumsum(counts)
        ids = self.ids[np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(self.first[word], counts)]
        upto = np.concatenate([[0], ends])
        bounds = upto[np.concatenate([[0], np.cumsum(sizes)])]
        return ids, np.diff(bounds)

    def _learn(self, words: list[str]):
        all_ids, all_counts, chunk, held = [self.ids], [np.diff(self.first)], [], 0
        for place, word in enumerate(words):
            chunk.append(_MARK + word)
            held += len(word) + 2
            if held >= CHUNK_CHARS or place == len(words) - 1:
                ids, counts = encode_words(chunk, self.model)
                all_ids.append(ids)
                all_counts.append(counts)
                chunk, held = [], 0
        self.ids = np.concatenate(all_ids)
        self.first = np.concatenate([[0], np.cumsum(np.concatenate(all_counts))]).astype(np.int64)


def encode(docs: DataFrame, keep: list[str], path: str = MODEL) -> DataFrame:
    """Rows (``keep``, ``sp_ids``) for every row of ``docs``: the ids of its text, an empty list for a
    null or empty one. A column ``sp_ids`` is replaced. ``path`` is the model file on every machine."""
    keep = [c for c in keep if c != "sp_ids"]
    frame = docs.select([f"`{c}`" for c in dict.fromkeys([*keep, "text"])])
    schema = T.StructType([f for f in frame.schema.fields if f.name in keep] + [T.StructField("sp_ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Model(path))
        for piece in slices(batches, 1000):
            ids, sizes = encoder.encode(piece.column("text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            names = [c for c in piece.schema.names if c in keep]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), lists], names=[*names, "sp_ids"])

    return frame.mapInArrow(run, schema)


def decode(encoded: DataFrame, keep: list[str], path: str = MODEL) -> DataFrame:
    """Rows (``keep``, ``sp_text``): the text of the ids in ``sp_ids``; null ids give null, none give
    an empty text. A literal word mark of the original comes back as a space."""
    keep = [c for c in keep if c not in ("sp_ids", "sp_text")]
    frame = encoded.select([f"`{c}`" for c in dict.fromkeys([*keep, "sp_ids"])])
    schema = T.StructType([f for f in frame.schema.fields if f.name in keep] + [T.StructField("sp_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(path)
        for piece in slices(batches, 1000):
            lists = piece.column("sp_ids").to_pylist()
            texts = [None if ids is None else model.decode(ids) for ids in lists]
            names = [c for c in piece.schema.names if c in keep]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, "sp_text"]
            )

    return frame.mapInArrow(run, schema)


def summaries(docs: DataFrame, keep: list[str], path: str = MODEL) -> DataFrame:
    """Rows (``keep``, ``n_tokens``, ``n_bytes_spelled``, ``ids_sha256``, ``round_trip``) for every row of
    ``docs``, without sending ids back: tokens, those that are single bytes, a digest of the ids as
    comma-joined text, and whether decoding gives the text again."""
    names = ("n_tokens", "n_bytes_spelled", "ids_sha256", "round_trip")
    keep = [c for c in keep if c not in names]
    frame = docs.select([f"`{c}`" for c in dict.fromkeys([*keep, "text"])])
    added = [T.LongType(), T.LongType(), T.StringType(), T.BooleanType()]
    schema = T.StructType([f for f in frame.schema.fields if f.name in keep] + [T.StructField(n, t) for n, t in zip(names, added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(path)
        encoder = Encoder(model)
        byte_id = np.zeros(len(model.decoded), bool)
        byte_id[model.byte] = True
        for piece in slices(batches, 1000):
            texts = piece.column("text").to_pylist()
            ids, sizes = encoder.encode(texts)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            spelled, digests, same = [], [], []
            for text, a, b in zip(texts, bounds, bounds[1:]):
                mine = ids[a:b]
                listed = mine.tolist()
                spelled.append(int(byte_id[mine].sum()))
                digests.append(hashlib.sha256(",".join(map(str, listed)).encode()).hexdigest())
                same.append(model.decode(listed) == (text or "").replace(_MARK, " "))
            kept = [c for c in piece.schema.names if c in keep]
            columns = [pa.array(sizes, pa.int64()), pa.array(spelled, pa.int64()), pa.array(digests), pa.array(same)]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *columns], names=[*kept, *names])

    return frame.mapInArrow(run, schema)


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` encoded and decoded again."""
    return summaries(table(spark, sf_dir, "documents"), ["doc_id"])
