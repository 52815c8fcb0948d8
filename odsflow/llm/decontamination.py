"""Benchmark decontamination by an FM-index of every training shard.

A shard is a run of words of the documents of one task: of one batch of rows, or of a million words
if that is less, so that an index stays small. Words that no test text holds become one
symbol, so the alphabet is that of the tests. The index keeps the Burrows-Wheeler transform of
the shard in a wavelet matrix (one bit vector with rank counts per bit of the alphabet) and a
sample of suffix positions. Test windows are searched backwards, all at once, by rank queries;
occurrences are located by walking back to a sampled position; overlapping occurrences merge
into removal spans. The tests go to the tasks, in blocks of bounded size, one after the other.
With one block nothing is shuffled; with several, only rows that share something are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import WORD_BYTES, slices, table, written

WINDOW = 10
#: Words of one index; longer inputs are cut with an overlap of a window.
SHARD_WORDS = 1_000_000
#: A suffix position is kept for each so many words of a run, and for the start of every run.
SAMPLE = 16
#: UTF-8 bytes of test texts that go to the tasks at once; longer tests than a sixteenth are cut for it.
BLOCK_BYTES = 16_000_000

_ADDED = T.StructType(
    [
        T.StructField("dc_words", T.LongType()),
        T.StructField("dc_hit", T.LongType()),
        T.StructField("dc_items", T.ArrayType(T.StringType())),
        T.StructField(
            "dc_spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
    ]
)


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """Rank and access on a sequence of symbols under ``1 << width``."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.levels = []
        for bit in range(width - 1, -1, -1):
            ones = (symbols >> bit) & 1 != 0
            self.levels.append((bit, Bits(ones)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``."""
        first = np.zeros_like(place)
        for bit, level in self.levels:
            one = (symbol >> bit) & 1 != 0
            first_ones, ones = level.rank(first), level.rank(place)
            first = np.where(one, level.zeros + first_ones, first - first_ones)
            place = np.where(one, level.zeros + ones, place - ones)
        return place - first

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(place)
        for bit, level in self.levels:
            one, ones = level.get(place), level.rank(place)
            symbol |= one.astype(np.int64) << bit
            place = np.where(one, level.zeros + ones, place - ones)
        return symbol


def suffix_order(symbols: np.ndarray, width: int) -> np.ndarray:
    """Start places of all suffixes in order.

    Symbol 0 ends a suffix; suffixes that are equal up to it stand in text order, and those that
    start with it come first.
    """
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    left = np.append(ends, n)[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    starts = np.flatnonzero(symbols)
    per_key = max(1, 62 // width)
    depth = per_key * -(-WINDOW // per_key)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(depth, np.int64)])
    keys, alive = [], left[starts]
    for first in range(0, depth, per_key):
        key = np.zeros(len(starts), np.int64)
        for j in range(first, first + per_key):
            key = (key << width) | np.where(alive > j, padded[starts + j], 0)
        keys.append(key)
    order = np.lexsort(keys[::-1])
    same = np.ones(max(0, len(order) - 1), bool)
    for key in keys:
        sorted_key = key[order]
        same &= sorted_key[1:] == sorted_key[:-1]
    rows = starts[order]
    same &= left[rows[1:]] >= depth  # shorter suffixes are already told apart by their places
    rank = np.empty(n, np.int64)
    rank[ends] = np.arange(len(ends))
    head = np.concatenate([[True], ~same])[: len(rows)]
    rank[rows] = len(ends) + np.maximum.accumulate(np.where(head, np.arange(len(rows)), 0))
    while same.any():  # double the compared depth for what is still equal
        open_rows = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        places = rows[open_rows]
        group, following = rank[places], rank[np.minimum(places + depth, n - 1)]
        again = np.lexsort((following, group))
        places, group, following = places[again], group[again], following[again]
        rows[open_rows] = places
        equal = (group[1:] == group[:-1]) & (following[1:] == following[:-1])
        head = np.concatenate([[True], ~equal])
        rank[places] = len(ends) + np.maximum.accumulate(np.where(head, open_rows, 0))
        same[:] = False
        same[open_rows[1:][equal] - 1] = True
        depth *= 2
    return np.concatenate([ends, rows])


class FMIndex:
    """Search and locate in a sequence of symbols whose last one is 0."""

    def __init__(self, symbols: np.ndarray, width: int):
        order = suffix_order(symbols, width)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1 << width))])
        previous = symbols[order - 1]
        self.transform = WaveletMatrix(previous, width)
        ends = np.flatnonzero(symbols == 0)
        following = np.searchsorted(ends, order)
        run_start = np.where(following > 0, ends[following - 1] + 1, 0)
        sampled = ((order - run_start) % SAMPLE == 0) | (previous == 0)
        self.sampled = Bits(sampled)
        self.positions = order[sampled]
        self.size = len(symbols)

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows (symbols from the left, padded) that occur, with their first and last row."""
        alive = np.arange(len(windows))
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.size, np.int64)
        found = []
        for step in range(1, windows.shape[1] + 1):
            symbol = windows[alive, lengths[alive] - step]
            low = self.before[symbol] + self.transform.rank(symbol, low)
            high = self.before[symbol] + self.transform.rank(symbol, high)
            there = low < high
            alive, low, high = alive[there], low[there], high[there]
            done = lengths[alive] == step
            found.append((alive[done], low[done], high[done]))
            alive, low, high = alive[~done], low[~done], high[~done]
            if not len(alive):
                break
        return tuple(np.concatenate(parts) for parts in zip(*found))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in the given rows."""
        places, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_rows = np.arange(len(rows))
        rows = rows.copy()
        while len(open_rows):
            here = rows[open_rows]
            known = self.sampled.get(here)
            places[open_rows[known]] = self.positions[self.sampled.rank(here[known])] + steps[open_rows[known]]
            open_rows, here = open_rows[~known], here[~known]
            symbol = self.transform.access(here)
            rows[open_rows] = self.before[symbol] + self.transform.rank(symbol, here)
            steps[open_rows] += 1
        return places


class Tests:
    """Windows of a block of test texts as symbols, and the items that hold each."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.ids = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(self.ids)}
        self.symbol: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            symbols = [self.symbol.setdefault(w, len(self.symbol) + 1) for w in text.translate(WORD_BYTES).split()]
            for i in range(max(len(symbols) - WINDOW + 1, 1) if symbols else 0):
                holders.setdefault(tuple(symbols[i : i + WINDOW]), set()).add(number[item])
        self.width = max(1, len(self.symbol).bit_length())
        self.lengths = np.array([len(w) for w in holders], np.int64)
        self.windows = np.zeros((len(holders), WINDOW), np.int64)
        for row, window in enumerate(holders):
            self.windows[row, : len(window)] = window
        self.first = np.concatenate([[0], np.cumsum([len(h) for h in holders.values()])]).astype(np.int64)
        self.items = np.array([i for h in holders.values() for i in sorted(h)], np.int64)


def expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [first, last), and the range each comes from."""
    sizes = last - first
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner], owner


def occurrences(symbols: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Places of test windows in the sequence, and the number of the window at each."""
    places, windows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, max(1, len(symbols) - WINDOW), SHARD_WORDS):
        shard = np.append(symbols[start : start + SHARD_WORDS + WINDOW - 1], 0)
        index = FMIndex(shard, tests.width)
        window, low, high = index.search(tests.windows, tests.lengths)
        rows, owner = expand(low, high)
        places.append(index.locate(rows) + start)
        windows.append(window[owner])
    return np.concatenate(places), np.concatenate(windows)


def _scan(texts: list[bytes | None], tests: Tests) -> tuple[list, list, list, list]:
    """Per text: words, hit words, items (strings) and removal spans (bytes), for one block of tests."""
    get, sequences = tests.symbol.get, []
    for text in texts:
        split = text.translate(WORD_BYTES).split() if text else ()
        sequences.append(np.array([get(word, 0) for word in split], np.int64))
    sizes = np.array([len(s) for s in sequences], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int64)
    for start, sequence in zip(first, sequences):
        symbols[start : start + len(sequence)] = sequence
    del sequences
    places, windows = occurrences(symbols, tests) if len(tests.windows) else (np.empty(0, np.int64),) * 2
    edges = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + tests.lengths[windows], -1)
    hit = np.cumsum(edges[:-1]) > 0
    doc = np.searchsorted(first, places, side="right") - 1
    items, owner = expand(tests.first[windows], tests.first[windows + 1])
    pairs = np.unique(doc[owner] * max(1, len(tests.ids)) + tests.items[items])
    found = [[] for _ in texts]
    for pair in pairs.tolist():
        found[pair // len(tests.ids)].append(tests.ids[pair % len(tests.ids)])
    hits, spans = [0] * len(texts), [[] for _ in texts]
    for d in np.unique(doc).tolist():
        mine = hit[first[d] : first[d] + sizes[d]]
        hits[d] = int(mine.sum())
        spans[d] = _byte_spans(texts[d], mine)
    return sizes.tolist(), hits, found, spans


def _byte_spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of hit words as byte offsets of the text."""
    steps = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    bounds = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORD_BYTES))]
    return [
        (bounds[a][0], bounds[b - 1][1]) for a, b in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1))
    ]


def _joined(text: bytes, left: list, right: list) -> tuple[list[tuple[int, int]], int]:
    """Union of two lists of spans, and the words inside."""
    merged: list[list[int]] = []
    for start, end in sorted([(s["start"], s["end"]) for s in left] + right):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    clean = text.translate(WORD_BYTES)
    # Spans of neighbouring words leave only separators between them.
    runs: list[list[int]] = []
    for start, end in merged:
        if runs and not clean[runs[-1][1] : start].strip():
            runs[-1][1] = end
        else:
            runs.append([start, end])
    return [tuple(r) for r in runs], sum(len(clean[a:b].split()) for a, b in runs)


def pieces(text: bytes, limit: int) -> list[bytes]:
    """A test text as itself, or as runs of words of about ``limit`` bytes that overlap by a window less
    one word, so that every window stands whole in a run. A run has ten words even if they are longer."""
    if len(text) <= limit:
        return [text]
    words, out, start = text.translate(WORD_BYTES).split(), [], 0
    while True:
        end, size = start, 0
        while end < len(words) and (end - start < WINDOW or size < limit):
            size += len(words[end]) + 1
            end += 1
        out.append(b" ".join(words[start:end]))
        if end == len(words):
            return out
        start = end - WINDOW + 1


def _cut_tests(tests: DataFrame, limit: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                runs = [run.decode() for run in pieces(text.encode(), limit)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(runs)), pa.array(runs)], names=["id", "text"])

    return tests.mapInArrow(cut, tests.schema).distinct()


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _columns(words: list, hits: list, items: list, spans: list) -> list[pa.Array]:
    ranges = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPANS)
    return [pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())), ranges]


def _in_one_block(docs: DataFrame, tests: DataFrame, keep: list[str]) -> DataFrame:
    """All tests go to the tasks at once, and every row is read once."""
    shared = docs.sparkSession.sparkContext.broadcast([(r.id, r.text.encode()) for r in tests.collect()])
    schema = T.StructType([f for f in docs.schema.fields if f.name in keep] + _ADDED.fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_tests = Tests(shared.value)
        for batch in slices(batches, 2000):
            found = _columns(*_scan(batch.column("text").cast(pa.binary()).to_pylist(), block_tests))
            kept = [batch.column(c) for c in batch.schema.names if c in keep]
            names = [c for c in batch.schema.names if c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *found], names=[*names, *_ADDED.fieldNames()])

    return docs.mapInArrow(scan, schema)


def _in_blocks(docs: DataFrame, tests: DataFrame, blocks: int, keep: list[str]) -> DataFrame:
    """Blocks of tests one after the other, so that driver and tasks hold one of them at a time.

    Rows are numbered and written once. A block writes what it finds, with numbers and without
    texts; the finds of all blocks are joined to the rows and merged.
    """
    sc = docs.sparkSession.sparkContext
    numbered = written(docs.select(F.monotonically_increasing_id().alias("dc_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "numbered")
    tests = written(tests, "tests")
    texts = numbered.select("dc_row", F.col("row.text").alias("text"))
    schema = T.StructType([texts.schema["dc_row"], *_ADDED.fields[2:]])
    parts = []
    for block in range(blocks):
        here = tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        shared = sc.broadcast([(r.id, r.text.encode()) for r in here.collect()])

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block_tests = Tests(shared.value)
            for batch in slices(batches, 2000):
                found = _columns(*_scan(batch.column("text").cast(pa.binary()).to_pylist(), block_tests))
                rows = pa.RecordBatch.from_arrays([batch.column("dc_row"), *found[2:]], names=schema.fieldNames())
                yield rows.filter(pa.array([bool(n) for n in found[1].to_pylist()], pa.bool_()))

        parts.append(written(texts.mapInArrow(scan, schema), "found"))
        shared.destroy()
    finds = parts[0]
    for part in parts[1:]:
        finds = finds.union(part)
    # At most one row per block and document.
    finds = finds.groupBy("dc_row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("dc_items")))).alias("items"),
        F.flatten(F.collect_list("dc_spans")).alias("spans"),
    )
    joined = numbered.join(finds, "dc_row", "left").select("row.*", F.col("items").alias("dc_items"), F.col("spans").alias("dc_spans"))
    schema = T.StructType([f for f in docs.schema.fields if f.name in keep] + _ADDED.fields)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, hits, spans = [], [], []
            for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("dc_spans").to_pylist()):
                words.append(len((text or b"").translate(WORD_BYTES).split()))
                ranges, hit = _joined(text or b"", found or [], [])
                spans.append(ranges)
                hits.append(hit)
            items = [found or [] for found in batch.column("dc_items").to_pylist()]
            names = [f.name for f in schema.fields[: -len(_ADDED)]]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, *_columns(words, hits, items, spans)], names=[*names, *_ADDED.fieldNames()])

    return joined.mapInArrow(merge, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with what they share with ``benchmark`` (``item_id``, ``text``).

    Adds ``dc_words`` (words), ``dc_hit`` (words inside an occurrence of a window of ten test
    words, or of a whole shorter test), ``dc_items`` (ids of the tests found, as sorted strings)
    and ``dc_spans`` (byte ranges to remove, one per run of hit words). ``keep`` names the columns
    to pass through, all by default; columns of these four names are replaced. A null or empty
    text has no words; a test without words is never found; a null id counts as an empty one;
    tests with one id count as one. An empty benchmark finds nothing. Tests go to the tasks in
    blocks of about ``BLOCK_BYTES``, of which one is held at a time; a long test is cut into runs
    that are dealt over the blocks. The order of the rows is kept in one block only.
    """
    added = _ADDED.fieldNames()
    tests = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()  # repeated rows would all fall into one block
    limit = max(BLOCK_BYTES // 16, 1)
    size = F.octet_length("text")
    total, longest = tests.agg(F.sum(size), F.max(size)).first()
    if (total or 0) >= BLOCK_BYTES and longest > limit:
        tests = written(_cut_tests(tests, limit), "pieces")
        total = tests.agg(F.sum(size)).first()[0]
    blocks = (total or 0) // BLOCK_BYTES + 1
    keep = [c for c in (keep or docs.columns) if c not in added]
    frame = docs.select([f"`{c}`" for c in dict.fromkeys([*keep, "text"])])
    return _in_one_block(frame, tests, keep) if blocks == 1 else _in_blocks(frame, tests, blocks, keep)


def without_tests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the removal spans cut from every text, and ``n_chars`` set to what is left. A text
    that shares nothing with the tests is unchanged."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    packed = docs.select("text", F.struct(*rest, F.lit(None).cast("boolean").alias("_")).alias("row"))
    found = decontaminate(packed, benchmark).select("row", "text", "dc_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column("dc_spans").to_pylist()):
                if spans:
                    data, last, kept = texts[i].encode(), 0, []
                    for span in spans:
                        kept.append(data[last : span["start"]])
                        last = span["end"]
                    texts[i] = b"".join([*kept, data[last:]]).decode()
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    schema = T.StructType([found.schema["row"], T.StructField("text", T.StringType())])
    clean = found.mapInArrow(cut, schema)
    clean = clean.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def op10_fm_index(spark, sf_dir: str) -> DataFrame:
    """What every row of ``documents`` shares with ``benchmark``."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        F.col("dc_words").alias("n_words"),
        F.col("dc_hit").alias("n_hit"),
        F.size("dc_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("dc_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("dc_hit") > 0).alias("contaminated"),
        F.size("dc_spans").cast("long").alias("n_spans"),
    )


SQL = f"""
WITH words AS (
    SELECT row, doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM (SELECT row_number() OVER () AS row, doc_id,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
tests AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark),
sought AS (
    SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS phrase
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS i FROM tests WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM sought),
places AS (
    SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes)),
found AS (SELECT row, i, places.n, item FROM places JOIN sought USING (n, phrase)),
hits AS (
    SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS place FROM found) GROUP BY row),
runs AS (
    SELECT row, count(*) AS n_spans FROM (
        SELECT row, place, place - lag(place) OVER (PARTITION BY row ORDER BY place) AS step
        FROM (SELECT DISTINCT row, unnest(range(i, i + n)) AS place FROM found)) WHERE step IS NULL OR step > 1 GROUP BY row),
items AS (SELECT row, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_spans, 0)::BIGINT AS n_spans
FROM words LEFT JOIN hits USING (row) LEFT JOIN runs USING (row) LEFT JOIN items USING (row)
"""
