"""Bytes of texts that stand inside a long string which starts twice or more in the corpus.

Every window of 200 bytes belongs to one anchor, the least hash of the short grams inside it, so
equal windows always meet under one anchor. Consecutive windows of one anchor form a stretch of
text. Stretches whose anchor occurs once are unique and never leave their task; the others are
brought together by anchor, equal ones once, and ordered by a suffix array: windows that are
equal stand side by side in it. The array is built by linear grouping: suffixes are grouped by
their Lyndon prefixes, in descending order, using pointers to the previous smaller suffix, and
each group's order then follows from the order of what comes after it.

An anchor with very many different stretches (the edge of a passage that countless documents
share) is dealt out again by longer grams, up to the whole window.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import slices, sorted_groups, table, written

WINDOW = 200
#: Bytes of the grams that anchor a window, at first and for crowded anchors.
GRAMS = (32, 125, 175, 195, 200)
#: Different stretches that one suffix array orders; more are dealt out by the next gram.
CROWD = 20_000
#: Bytes of stretches whose windows are hashed at once.
TOGETHER = 1 << 19
#: Bytes that are hashed at once, and windows of one stretch, at most.
SECTION = 1 << 17
STRETCH = 256

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def suffix_array(symbols: list[int]) -> list[int]:
    """Order of all suffixes of a sequence whose last symbol is 0, smaller than all others."""
    n = len(symbols)
    grouped = sorted(range(n), key=symbols.__getitem__)
    head, size, place = [0] * n, [0] * n, [0] * n  # first place of each suffix's group, groups, places
    start, last = 0, -1
    for at, i in enumerate(grouped):
        if symbols[i] != last:
            start, last = at, symbols[i]
        head[i] = start
        size[start] += 1
        place[i] = at
    smaller = [-1] * n  # the previous suffix in a smaller group
    end = n
    while end > 1:
        first = head[grouped[end - 1]]
        holders: dict[int, int] = {}  # how many suffixes of the group follow each smaller one
        for i in sorted(grouped[first:end]) if end - first > 1 else grouped[first:end]:
            p = i - 1
            while p >= 0 and head[p] >= first:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                holders[p] = holders.get(p, 0) + 1
        end = first
        # Prefixes that this group extends leave their groups for larger ones behind them, those
        # that it extends most often first.
        times: dict[int, list[int]] = {}
        for p, count in holders.items():
            times.setdefault(count, []).append(p)
        for count in sorted(times, reverse=True) if len(times) > 1 else times:
            leaving = times[count]
            for p in leaving:
                group = head[p]
                size[group] -= 1
                at, old = group + size[group], place[p]
                other = grouped[at]
                grouped[old], grouped[at] = other, p
                place[other], place[p] = old, at
            for p in leaving:
                head[p] += size[head[p]]
            for p in leaving:
                size[head[p]] += 1
    order, free, placed = [0] * n, list(range(n)), [False] * n
    order[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        p = order[i] - 1
        while p >= 0 and not placed[p]:
            placed[p] = True
            group = head[p]
            order[free[group]] = p
            free[group] += 1
            p = smaller[p]
    return order


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            tables.append(np.multiply.accumulate(out))
        _POWERS[0] = tuple(tables)
    return _POWERS[0][0][:n], _POWERS[0][1][:n]


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all grams of the data."""
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _least_gram(data: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams of the data, and the least one of the grams of each window."""
    hashes = _gram_hashes(data, gram)
    least, count, width = hashes, WINDOW - gram + 1, 1
    while width * 2 <= count:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return hashes, np.minimum(least[: len(least) - (count - width)], least[count - width :])


def stretches(texts: list[bytes], gram: int) -> tuple[np.ndarray, ...]:
    """All stretches of all texts: number of the text, first window, windows, anchor, and how many
    places inside the anchor takes (over one where the text repeats itself)."""
    found, together, held = [], [], 0

    def flush():
        nonlocal together, held
        if not together:
            return
        sizes = np.array([len(part) for _, _, part in together], np.int64)
        data = np.frombuffer(b"".join(part for _, _, part in together), np.uint8)
        first = np.cumsum(sizes) - sizes
        hashes, least = _least_gram(data, gram)
        starts = np.concatenate([np.arange(f, f + s - WINDOW + 1) for f, s in zip(first, sizes)])
        part = np.repeat(np.arange(len(sizes)), sizes - WINDOW + 1)
        hashes, least = hashes[starts], least[starts]
        inside = starts - first[part]
        new = np.ones(len(starts), bool)
        new[1:] = (least[1:] != least[:-1]) | (part[1:] != part[:-1])
        heads = np.flatnonzero(new)
        passed = np.zeros(len(starts), np.int64)
        passed[1:] = hashes[:-1] == least[:-1]
        passed[heads] = 0
        times = 1 + np.add.reduceat(passed, heads)
        counts = np.diff(np.append(heads, len(starts)))
        if counts.max() > STRETCH:
            pieces = -(-counts // STRETCH)
            which = np.repeat(np.arange(len(heads)), pieces)
            step = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            heads, counts = heads[which] + step * STRETCH, np.minimum(counts[which] - step * STRETCH, STRETCH)
            times = times[which]
        owner = np.array([number for number, _, _ in together], np.int64)
        offset = np.array([offset for _, offset, _ in together], np.int64)
        start = inside[heads] + offset[part[heads]]
        found.append((owner[part[heads]], start, counts, least[heads].view(np.int64), times))
        together, held = [], 0

    for number, text in enumerate(texts):
        for offset in range(0, len(text) - WINDOW + 1, SECTION):
            part = text[offset : offset + SECTION + WINDOW - 1]
            together.append((number, offset, part))
            held += len(part)
            if held >= SECTION:
                flush()
    flush()
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate([empty, *(x[i] for x in found)]) for i in range(5))


def _names(parts: list[bytes]) -> np.ndarray:
    """Two numbers that stand for each string."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(p) for p in parts), np.int64).reshape(-1, 2)


def repeated(parts: list[bytes], counts: list[int]) -> list[list[tuple[int, int]]]:
    """Ranges of windows of each string that occur elsewhere among the strings, or in the string
    itself, or in any window when the string stands for several places."""
    if min(counts) > 1:
        return [[(0, len(part) - WINDOW + 1)] for part in parts]
    joined, bound = [], []
    for part in parts:
        bound.append(len(joined))
        joined += [byte + 2 for byte in part]
        joined.append(1)
    joined[-1] = 0
    data = b"\0".join(parts)
    last = [-1] * len(data)  # the string of every whole window
    for number, (first, part) in enumerate(zip(bound, parts)):
        windows = len(part) - WINDOW + 1
        last[first : first + windows] = [number] * windows
    last.append(-1)
    hit = bytearray(len(data) + 1)
    before = before_text = None
    for i in suffix_array(joined):
        if last[i] < 0:
            continue
        text = data[i : i + WINDOW]
        if text == before_text:
            hit[i] = hit[before] = 1
        before, before_text = i, text
    out = []
    for first, part, count in zip(bound, parts, counts):
        windows = len(part) - WINDOW + 1
        mine = b"\1" * windows if count > 1 else bytes(hit[first : first + windows])
        ranges, at = [], mine.find(1)
        while at >= 0:
            end = mine.find(0, at)
            end = windows if end < 0 else end
            ranges.append((at, end))
            at = mine.find(1, end)
        out.append(ranges)
    return out


def _ordered(groups: list[tuple[list, list[bytes], list[int]]]) -> list[tuple[int, int, int, int]]:
    """Repeated windows (s1, s2, first, last) of groups of different stretches (names, texts, places).

    A stretch with several places is repeated as a whole. Of the others, windows whose hash no other
    window of the group has are set aside; what is left of them, and all they may be equal to, is
    ordered by a suffix array, which decides.
    """
    parts = [part for _, texts, _ in groups for part in texts]
    places = np.array([n for _, _, counts in groups for n in counts], np.int64)
    group = np.repeat(np.arange(len(groups)), [len(texts) for _, texts, _ in groups])
    size = np.array([len(part) for part in parts], np.int64)
    first = np.cumsum(size) - size
    data = np.frombuffer(b"".join(parts), np.uint8)
    windows = size - WINDOW + 1
    owner = np.repeat(np.arange(len(parts)), windows)
    begin = np.cumsum(windows) - windows
    inside = np.arange(len(owner)) - begin[owner]
    hashes = _gram_hashes(data, WINDOW)[first[owner] + inside]
    hashes ^= group[owner].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
    maybe = (times[which] > 1) | (places[owner] > 1)
    heads = begin
    low = np.minimum.reduceat(np.where(maybe, inside, size[owner]), heads)
    high = np.maximum.reduceat(np.where(maybe, inside + 1, 0), heads)
    out, at = [], 0
    for names, texts, counts in groups:
        lows, highs = low[at : at + len(texts)].tolist(), high[at : at + len(texts)].tolist()
        at += len(texts)
        if min(counts) > 1:
            out += [(*name, 0, len(text) - WINDOW + 1) for name, text in zip(names, texts)]
            continue
        pieces: dict[bytes, int] = {}
        for text, a, b, count in zip(texts, lows, highs, counts):
            if b > a:
                piece = text[a : b + WINDOW - 1]
                pieces[piece] = pieces.get(piece, 0) + count
        if not pieces:
            continue
        ranges = dict(zip(pieces, repeated(list(pieces), list(pieces.values()))))
        for name, text, a, b in zip(names, texts, lows, highs):
            if b > a:
                out += [(*name, a + x, a + y) for x, y in ranges[text[a : b + WINDOW - 1]]]
    return out


def _extract(frame: DataFrame, text: bool) -> DataFrame:
    """Stretches of candidate anchors. With ``text``: each different one of a batch with the number of
    its places (anchor, s1, s2, places, part). Without: every place (rid, start, s1, s2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, parts, rids, starts = [], [], [], []
            for rid, whole, found in zip(*(batch.column(c).to_pylist() for c in ("rid", "whole", "found"))):
                for one in found:
                    anchors.append(one["anchor"])
                    starts.append(one["start"])
                    parts.append(whole[one["start"] : one["start"] + one["windows"] + WINDOW - 1])
                    rids.append(rid)
            if not parts:
                continue
            names = _names(parts)
            if not text:
                columns = [pa.array(rids, pa.int64()), pa.array(starts, pa.int64()), *(pa.array(names[:, i]) for i in (0, 1))]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "start", "s1", "s2"])
                continue
            _, first, counts = np.unique(names, axis=0, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([anchors[i] for i in first], pa.int64()),
                    *(pa.array(names[first, i]) for i in (0, 1)),
                    pa.array(counts, pa.int64()),
                    pa.array([parts[i] for i in first], pa.binary()),
                ],
                names=["anchor", "s1", "s2", "places", "part"],
            )

    schema = "anchor long, s1 long, s2 long, places long, part binary" if text else "rid long, start long, s1 long, s2 long"
    return frame.mapInArrow(run, schema)


def _resolve(rows: DataFrame, level: int) -> DataFrame:
    """Rows (s1, s2, first, last): ranges of repeated windows of every different stretch in ``rows``
    (anchor, s1, s2, places, part), which may hold a stretch several times."""

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together, held = [], 0
        for _, group in itertools.chain(sorted_groups(batches, "anchor"), [(None, None)]):
            if group is not None:
                counts, parts = {}, {}
                for s1, s2, places, part in zip(group["s1"].tolist(), group["s2"].tolist(), group["places"].tolist(), group["part"]):
                    counts[s1, s2] = counts.get((s1, s2), 0) + places
                    parts[s1, s2] = part
                together.append((list(parts), list(parts.values()), list(counts.values())))
                held += sum(map(len, parts.values()))
            if together and (group is None or held >= TOGETHER):
                found = _ordered(together)
                together, held = [], 0
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in zip(*found)], names=["s1", "s2", "first", "last"]
                    )

    crowded = written(rows.groupBy("anchor").count().where(F.col("count") > CROWD).select("anchor"), "crowded")
    some = not crowded.isEmpty()
    small = rows.join(crowded, "anchor", "left_anti") if some else rows
    small = small.repartition("anchor").sortWithinPartitions("anchor")
    found = small.mapInArrow(order, "s1 long, s2 long, first long, last long")
    if not some:
        return found

    gram = GRAMS[level + 1]

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("part").to_pylist()
            owner, start, windows, anchor, times = stretches(whole, gram)
            if not len(owner):
                continue
            parts = [whole[o][s : s + w + WINDOW - 1] for o, s, w in zip(owner.tolist(), start.tolist(), windows.tolist())]
            # With the whole window as gram, all windows of a stretch are equal: one of them names it.
            names = _names([part[:WINDOW] for part in parts] if gram == WINDOW else parts)
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("s1").take(take),
                    batch.column("s2").take(take),
                    batch.column("places").take(take),
                    pa.array(start),
                    pa.array(times),
                    pa.array(anchor),
                    pa.array(names[:, 0]),
                    pa.array(names[:, 1]),
                    pa.array(parts, pa.binary()),
                ],
                names=["p1", "p2", "places", "start", "times", "anchor", "s1", "s2", "part"],
            )

    schema = "p1 long, p2 long, places long, start long, times long, anchor long, s1 long, s2 long, part binary"
    parents = rows.join(crowded, "anchor", "left_semi")
    finer = written(parents.drop("anchor").mapInArrow(again, schema), "finer")
    if gram == WINDOW:
        windows = F.octet_length("part").cast("long") - (WINDOW - 1)
        finer = finer.select("p1", "p2", "places", "start", "s1", "s2", windows.alias("windows"))
        twice = finer.groupBy("s1", "s2").agg(F.sum(F.col("places") * F.col("windows")).alias("n")).where("n > 1")
        inner = finer.join(twice.select("s1", "s2"), ["s1", "s2"], "left_semi")
        inner = inner.select("p1", "p2", "start", F.lit(0).alias("first"), F.col("windows").alias("last")).distinct()
    else:
        twice = finer.groupBy("anchor").agg(F.sum(F.col("places") * F.col("times")).alias("n")).where("n > 1").select("anchor")
        inner = _resolve(finer.join(twice, "anchor", "left_semi").select("anchor", "s1", "s2", "places", "part"), level + 1)
        inner = finer.select("p1", "p2", "start", "s1", "s2").distinct().join(inner, ["s1", "s2"])
    return found.union(
        inner.select(
            F.col("p1").alias("s1"), F.col("p2").alias("s2"), (F.col("start") + F.col("first")).alias("first"),
            (F.col("start") + F.col("last")).alias("last"),
        )
    )


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` as (rid, row, whole); rid follows from the file and the place of the row in it, so it
    is the same whenever the rows are read. Rows that do not come straight from files are written."""
    rid = F.expr("xxhash64(_metadata.file_path) div 2 + _metadata.row_index").alias("rid")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(None).alias("_")]).alias("row")
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("whole")
    if not _one_row_per_file_row(docs._jdf.queryExecution().analyzed()):
        docs = written(docs, "suffix-rows")
    return docs.select(rid, row, whole)


def _one_row_per_file_row(plan) -> bool:
    """Whether a plan only filters and computes columns of rows of files."""
    if plan.nodeName() not in ("Project", "Filter", "LogicalRelation"):
        return False
    children = plan.children()
    return all(_one_row_per_file_row(children.apply(i)) for i in range(children.size()))


@dataclass(frozen=True)
class Repeats:
    """What was found: all rows (rid, row, whole), their sizes and digests (rid, row, n_bytes, sha256),
    the texts that may be cut (rid, whole), and what to cut (rid, spans)."""

    rows: DataFrame
    figures: DataFrame
    candidates: DataFrame
    spans: DataFrame


def repeated_spans(docs: DataFrame) -> Repeats:
    """The maximal runs of bytes of each text that are covered by a 200-byte string which starts at
    another place too, in the same text or any other.

    ``rid`` numbers the rows of ``docs``, ``row`` holds their columns other than ``text``, ``whole``
    the text as bytes. A null text is empty; texts under 200 bytes have no such string. Repeated
    rows count as different places.
    """
    numbered = _numbered(docs)
    anchor_type = T.ArrayType(
        T.StructType(
            [T.StructField(name, T.LongType()) for name in ("anchor", "start", "windows", "times")]
        )
    )
    schema = T.StructType(
        [
            *(f for f in numbered.schema.fields if f.name != "whole"),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("sha256", T.StringType()),
            T.StructField("anchors", anchor_type),
        ]
    )

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("whole").to_pylist()
            owner, *values = stretches(texts, GRAMS[0])
            offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            start, windows, anchor, times = (pa.array(x) for x in values)
            values = pa.StructArray.from_arrays([anchor, start, windows, times], names=["anchor", "start", "windows", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid"),
                    batch.column("row"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets), values),
                ],
                names=["rid", "row", "n_bytes", "sha256", "anchors"],
            )

    rows = written(numbered.mapInArrow(anchors, schema), "suffix-anchors")
    places = rows.select("rid", F.inline("anchors"))
    twice = places.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    found = places.join(twice, "anchor").groupBy("rid").agg(F.collect_list(F.struct("anchor", "start", "windows")).alias("found"))
    candidates = written(numbered.select("rid", "whole").join(found, "rid"), "suffix-candidates")

    ranges = _resolve(_extract(candidates, True), 0)
    hits = _extract(candidates, False).join(ranges, ["s1", "s2"])
    hits = hits.groupBy("rid").agg(
        F.collect_list(F.struct((F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("last")).alias("b"))).alias("hits")
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for hits in batch.column("hits").to_pylist():
                spans: list[list[int]] = []
                for a, b in sorted((h["a"], h["b"] + WINDOW - 1) for h in hits):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                out.append([{"start": a, "end": b} for a, b in spans])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(out, span)], names=["rid", "spans"])

    spans = hits.mapInArrow(merge, "rid long, spans array<struct<start:long,end:long>>")
    return Repeats(numbered, rows.drop("anchors"), candidates.select("rid", "whole"), spans)


def without_spans(text: bytes, spans: list) -> bytes:
    """The text without the given byte ranges, which are sorted and apart."""
    kept, last = [], 0
    for span in spans:
        kept.append(text[last : span["start"]])
        last = span["end"]
    return b"".join([*kept, text[last:]])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut from every text, and ``n_chars`` set to what is left.

    Characters that a cut leaves in part go as a whole. A text that loses nothing is unchanged,
    but null becomes empty; one that loses all is empty.
    """
    found = repeated_spans(docs)
    joined = found.rows.join(found.spans, "rid", "left")
    columns = [c for c in docs.columns if c != "text"]
    schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            whole, spans = batch.column("whole").to_pylist(), batch.column("spans").to_pylist()
            texts = [without_spans(w, s).decode("utf-8", "ignore") if s else w.decode() for w, s in zip(whole, spans)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    texts = joined.select("row", "whole", "spans").mapInArrow(cut, schema)
    kept = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    kept = texts.select(*kept)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in columns else kept


def op4_suffix_array(spark, sf_dir: str) -> DataFrame:
    """What is removed from every row of ``documents``."""
    found = repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, spans = batch.column("whole").to_pylist(), batch.column("spans").to_pylist()
            kept = [hashlib.sha256(without_spans(w, s)).hexdigest() for w, s in zip(whole, spans)]
            removed = [sum(x["end"] - x["start"] for x in s) for s in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array(removed, pa.int64()), pa.array([len(s) for s in spans], pa.int64()), pa.array(kept)],
                names=["rid", "n_removed", "n_spans", "kept"],
            )

    cut = found.candidates.join(found.spans, "rid").mapInArrow(digest, "rid long, n_removed long, n_spans long, kept string")
    return found.figures.join(cut, "rid", "left").select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept", "sha256").alias("kept_sha256"),
    )
