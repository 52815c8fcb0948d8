"""Near-duplicate texts: Jaccard similarity of five-word shingles by chosen paths.

The set of a text is embedded as its minimal hashes; a token is (number of the hash, its value).
A run splits all sets on a sampled token: sets that share it meet in a node. A node that is still
large gives up the sets that are alike to its first one (its pivot) and is split again on further
tokens, sampled by the node itself, 1 / similarity of them on average; a small node is searched
by brute force. Runs repeat until a pair at the threshold is found with the target recall.

Pairs are never listed. What a node finds are ties to pivots that keep together all that may be
linked; connected ties give groups, in which every pair is then compared by its true sets, block
by block. Copies of a text take part once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import components, slices, sorted_groups, table, words, written

SHINGLE = 5
#: Two texts are linked when nine times their common shingles reach four times the sum of their sizes.
SIMILARITY = 0.8
RECALL = 0.999
HASHES = 64
#: Sets of a node that are searched by brute force; larger nodes are split, so many times at most.
LEAF = 2048
DEPTH = 6
#: A set follows a pivot from the first share of equal hashes, and is tied to it from the second.
#: If x is f similar to pivot p and 0.8 to y, then y and p are f - 0.2 similar at least.
FOLLOW = 0.76
TIE = 0.48
#: Shingles of one block of a large group.
BLOCK = 1_000_000
#: Shingles found in more texts of a comparison are counted by matrix products, others pair by pair.
RARE = 16


class _Numbers(dict):
    """Words of a task and their hashes, each computed once."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted hashes of the runs of five words of each text; a shorter text is one run."""
    numbers = _Numbers()
    split = [np.array([numbers[w] for w in words(text)], np.int64) for text in texts]
    hashes = np.array(numbers.hashes, np.uint64)
    rng = np.random.default_rng(5)
    factors = rng.integers(1 << 62, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = []
    for ids in split:
        h = hashes[ids] if len(ids) else np.empty(0, np.uint64)
        n = len(h) - SHINGLE + 1
        if n < 1:
            mixed = (h * factors[: len(h)]).sum(keepdims=True, dtype=np.uint64) if len(h) else h
        else:
            mixed = h[:n] * factors[0]
            for j in range(1, SHINGLE):
                mixed += h[j : n + j] * factors[j]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed.sort()
        keep = np.ones(len(mixed), bool)
        keep[1:] = mixed[1:] != mixed[:-1]
        out.append(mixed[keep])
    return out


def minimal_hashes(shingles: np.ndarray) -> np.ndarray:
    """The embedded set: the least value of each of 64 hash functions."""
    rng = np.random.default_rng(11)
    factor = rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    offset = rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), 2048):
        np.minimum(least, (short[start : start + 2048, None] * factor + offset).min(axis=0), out=least)
    return least.view(np.int32)


def success(depth: int, share: float = SIMILARITY) -> float:
    """Chance that one run of so many splits keeps a pair together that has this share of its minimal hashes in
    common: a node passes it on by its first token, and by a second one that every fourth node has."""
    chance = 1.0
    for _ in range(depth):
        chance = 1 - (1 - share * chance) * (1 - (1 / SIMILARITY - 1) * share * chance)
    return chance


def missed(number: int, depth: int = DEPTH) -> float:
    """Chance that so many runs miss a pair at the threshold. All runs sample the same minimal hashes, of which
    such a pair has a random number in common, so it is the mean over that number."""
    total = 0.0
    for same in range(HASHES + 1):
        weight = math.comb(HASHES, same) * SIMILARITY**same * (1 - SIMILARITY) ** (HASHES - same)
        total += weight * (1 - success(depth, same / HASHES)) ** number
    return total


def runs(recall: float = RECALL) -> int:
    """Runs until a pair at the threshold is found with this chance, however often its nodes are split."""
    number = 1
    while missed(number) > 1 - recall:
        number += 1
    return number


def _staged(docs: DataFrame) -> DataFrame:
    """Rows with a number, a key for equal texts, the size of their set and its embedding."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(7), text).alias("k2"),
        F.struct(*rest, F.lit(None).cast("boolean").alias("_")).alias("row"),
        F.col("text").alias("whole"),
    )
    schema = T.StructType(
        numbered.schema.fields
        + [T.StructField("n", T.LongType()), T.StructField("hashes", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            sets = shingle_sets(batch.column("whole").to_pylist())
            flat = np.concatenate([minimal_hashes(s) for s in sets]) if sets else np.empty(0, np.int32)
            offsets = np.arange(len(sets) + 1, dtype=np.int32) * HASHES
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=[*batch.schema.names, "n", "hashes"],
            )

    return written(numbered.mapInArrow(run, schema), "near-rows")


def _children(rows: DataFrame, salt: int) -> DataFrame:
    """Rows (node, rep) one split further down; ``rows`` has node, rep and hashes."""
    def child(slot: int):
        at = F.pmod(F.xxhash64(F.lit(salt), F.lit(slot), "node"), F.lit(HASHES)).cast("int")
        return F.xxhash64(F.lit(slot), "node", at, F.get("hashes", at))

    second = F.pmod(F.xxhash64(F.lit(salt), "node"), F.lit(4)) == 0
    slots = F.when(second, F.array(child(0), child(1))).otherwise(F.array(child(0)))
    return rows.select(F.explode(slots).alias("node"), "rep", "hashes")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes that hold two sets at least, with the number of sets and the first one."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("rep").alias("pivot")).where("size > 1")
    return rows.join(sizes, "node")


def _alike(a: str, b: str):
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    return same / F.lit(float(HASHES))


def _ties_in_leaf(rep: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ties of a small node: all sets that are alike to a leader are tied to it, and a set that
    follows none leads. Gives each tied set and the least set it is connected to."""
    order = np.argsort(rep, kind="stable")
    rep, hashes = rep[order], hashes[order]
    root, left = np.arange(len(rep)), np.arange(len(rep))
    while len(left) > 1:
        leader, rest = left[0], left[1:]
        alike = (hashes[rest] == hashes[leader]).sum(axis=1)
        met = np.unique(root[np.append(rest[alike >= TIE * HASHES], leader)])
        if len(met) > 1:
            root[np.isin(root, met)] = met[0]
        left = rest[alike < FOLLOW * HASHES]
    tied = np.flatnonzero(root != np.arange(len(rep)))
    return rep[tied], rep[root[tied]]


def _ties(sets: DataFrame, recall: float) -> DataFrame:
    """Rows (a, b) that connect all sets that may be linked."""
    starts = F.transform(F.sequence(F.lit(1), F.lit(runs(recall))), lambda run: F.xxhash64(run, F.lit(SHINGLE)))
    rows = _children(sets.select(F.explode(starts).alias("node"), "rep", "hashes"), 0).drop("hashes")
    rows = written(_sized(rows).join(sets.select("rep", "hashes"), "rep"), "near-nodes")
    found = []
    for level in range(1, DEPTH + 1):
        last = level == DEPTH
        leaves = rows if last else rows.where(F.col("size") <= LEAF)
        if last:
            # What is still large is dealt into blocks, and every two blocks are searched together.
            blocks = F.ceil(F.col("size") / LEAF).cast("int")
            mine = F.pmod(F.xxhash64("rep"), blocks).cast("int")
            pairs = F.transform(
                F.sequence(F.lit(0), blocks - 1), lambda o: F.xxhash64("node", F.least(mine, o), F.greatest(mine, o))
            )
            leaves = leaves.select(F.explode(pairs).alias("node"), "rep", "hashes")

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, group in sorted_groups(batches, "node"):
                a, b = _ties_in_leaf(group["rep"], group["hashes"])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        near = leaves.select("node", "rep", "hashes").repartition("node").sortWithinPartitions("node")
        found.append(written(near.mapInArrow(search, "a long, b long").distinct(), "near-ties"))
        large = rows.where(F.col("size") > LEAF)
        if last or large.isEmpty():
            break
        first = large.where("rep = pivot").select("node", F.col("hashes").alias("first")).dropDuplicates(["node"])
        judged = written(large.join(first, "node").withColumn("alike", _alike("hashes", "first")).drop("first"), "near-large")
        found.append(judged.where((F.col("alike") >= TIE) & (F.col("rep") != F.col("pivot"))).select(
            F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct())
        rows = _children(judged.where(F.col("alike") < FOLLOW).select("node", "rep", "hashes"), level)
        rows = written(_sized(rows), "near-nodes")
    ties = found[0]
    for more in found[1:]:
        ties = ties.union(more)
    return ties


def _links(left: list[np.ndarray], right: list[np.ndarray] | None) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of ``left``: its number and the numbers of linked sets of ``right``, or, without
    ``right``, of all linked sets of ``left``."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    head = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(head) - 1
    spread = np.bincount(column)
    first, last = (0, len(left)) if right is None else (len(left), len(sets))
    width = last - first

    common = spread[column] > RARE
    rows, cols = owner[common], np.unique(column[common], return_inverse=True)[1]
    n_cols = int(cols.max()) + 1 if len(cols) else 0
    # Rare shingles are held sorted, and each text knows its places among them.
    rare = ~common & (spread[column] > 1)
    rare_rows, rare_cols = owner[rare], column[rare]
    places = np.argsort(rare_rows, kind="stable")
    of_row = np.searchsorted(rare_rows[places], np.arange(len(left) + 1))
    del flat, owner, order, head, column, rare
    tile = max(1, min(1024, 8_000_000 // max(width, 1)))
    by_col = np.argsort(cols, kind="stable")
    rows, cols = rows[by_col], cols[by_col]
    for start in range(0, len(left), tile):
        end = min(start + tile, len(left))
        shared = np.zeros((end - start, width), np.float32)
        step = max(64, 8_000_000 // len(sets))
        for c in range(0, n_cols, step):
            a, b = np.searchsorted(cols, [c, c + step])
            dense = np.zeros((len(sets), min(step, n_cols - c)), np.float32)
            dense[rows[a:b], cols[a:b] - c] = 1
            shared += dense[start:end] @ dense[first:last].T
        # The texts of this tile and all that share a rare shingle with them: 1 to 15 places before or after.
        here = places[of_row[start] : of_row[end]]
        for gap in (*range(1 - RARE, 0), *range(1, RARE)):
            there = here + gap
            near = (there >= 0) & (there < len(rare_cols))
            mine, there = here[near], there[near]
            same = rare_cols[mine] == rare_cols[there]
            mine, other = rare_rows[mine[same]], rare_rows[there[same]]
            wanted = (other >= first) & (other < last)
            np.add.at(shared.reshape(-1), (mine[wanted] - start) * width + other[wanted] - first, np.float32(1))
        for i in range(start, end):
            linked = 9 * shared[i - start].astype(np.int64) >= 4 * (sizes[i] + sizes[first:last])
            if right is None:
                linked[i] = False
            yield i, np.flatnonzero(linked)


def _compare(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set, and the least set it is connected to, inside one comparison.

    ``side`` is 0 for sets to be compared among themselves, else 1 or 2: one side with the other.
    """
    order = np.lexsort((ids, side))
    ids, side = ids[order], side[order]
    sets = [sets[i] for i in order]
    cut = int((side < 2).sum())
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    split = bool(len(side)) and side[0] > 0
    if split and cut in (0, len(ids)):
        pairs = []
    else:
        pairs = _links(sets[:cut], sets[cut:]) if split else _links(sets, None)
    for i, others in pairs:
        if not len(others):
            continue
        others = others + cut if split else others
        links[i] += len(others)
        if split:
            links[others] += 1
        met = root[others]
        if met.min() != met.max() or met[0] != root[i]:
            met = np.unique(np.append(met, root[i]))
            root[np.isin(root, met)] = met[0]
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, root, ids)
    return links[np.argsort(order)], least[root][np.argsort(order)]


def near_classes(docs: DataFrame, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as written (``rid``, ``row``, ...), and for each ``rid`` its class.

    The second has (rid, root, n_copies, n_links): ``root`` is the rid of the least text of the
    class, ``n_copies`` the rows with the same text, ``n_links`` the different texts whose
    similarity reaches the threshold. Texts without words are linked to none and are classes of
    their own, as is every such row; equal texts with words are in one class; null is empty.
    """
    staged = _staged(docs)
    some = F.col("n") > 0
    texts = staged.where(some).groupBy("k1", "k2").agg(F.min("rid").alias("rep"), F.count("*").alias("n_copies"))
    texts = written(texts, "near-texts")
    sets = staged.where(some).select("rid", "n", "hashes").join(
        texts.select(F.col("rep").alias("rid")), "rid", "left_semi"
    ).withColumnRenamed("rid", "rep")
    sets = written(sets, "near-sets")
    groups = written(components(_ties(sets, recall), "near-groups"), "near-members")

    # Large groups are dealt into blocks; every two blocks are compared in one place.
    members = groups.join(sets.select(F.col("rep").alias("node"), "n"), "node")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    members = members.join(blocks, "root").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    mine, other = F.col("mine"), lambda o: F.struct(
        F.xxhash64("root", F.least("mine", o), F.greatest("mine", o)).alias("task"),
        F.when(F.col("mine") == o, 0).when(F.col("mine") < o, 1).otherwise(2).alias("side"),
    )
    members = members.select("node", F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), other).alias("tasks"))
    whole = staged.select(F.col("rid").alias("node"), "whole").join(members, "node")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            sets = [s.tobytes() for s in shingle_sets(batch.column("whole").to_pylist())]
            columns = [batch.column("node"), batch.column("tasks"), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "tasks", "shingles"])

    tasks = T.StructField("tasks", whole.schema["tasks"].dataType)
    schema = T.StructType([T.StructField("node", T.LongType()), tasks, T.StructField("shingles", T.BinaryType())])
    sent = whole.mapInArrow(to_sets, schema).select("node", "shingles", F.inline("tasks"))
    sent = sent.repartition("task").sortWithinPartitions("task")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in sorted_groups(batches, "task"):
            found = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
            links, least = _compare(group["node"], found, group["side"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(group["node"]), pa.array(links), pa.array(least)], names=["rep", "links", "least"]
            )

    compared = written(sent.mapInArrow(compare, "rep long, links long, least long"), "near-compared")
    links = compared.groupBy("rep").agg(F.sum("links").alias("n_links"))
    roots = components(compared.select(F.col("rep").alias("a"), F.col("least").alias("b")), "near-classes")
    known = texts.join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select(
        "k1", "k2", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "rep").alias("root")
    )
    with_words = staged.where(some).select("rid", "k1", "k2").join(known, ["k1", "k2"])
    classes = with_words.select("rid", "root", "n_copies", "n_links").union(
        staged.where(~some).select("rid", "rid", F.lit(1).cast("long"), F.lit(0).cast("long"))
    )
    return staged, written(classes, "near-result")


def one_of_each(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of each class of near duplicates: that with the least ``doc_id`` (null
    last). Rows without words all stay."""
    staged, classes = near_classes(docs, recall)
    ids = staged.select("rid", F.col("row.doc_id").alias("doc_id"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    best = classes.join(ids, "rid").groupBy("root").agg(F.min(order).getField("rid").alias("rid"))
    dropped = classes.join(best, "rid", "left_anti").select("rid")
    kept = staged.join(dropped, "rid", "left_anti")
    return kept.select(*[F.col("whole").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op8_chosen_path(spark, sf_dir: str) -> DataFrame:
    """Class, copies and links of every row of ``documents``; a class is named by its least doc_id."""
    staged, classes = near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = classes.join(staged.select("rid", F.col("row.doc_id").alias("doc_id")), "rid")
    names = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(names, "root").select("doc_id", "class_id", "class_size", "n_copies", "n_links")
