"""Token counts that follow edits without encoding a text again.

Each document keeps a segment tree over its pre-tokens; a node holds the characters and tokens
below it. An edit finds the pre-tokens it touches by descending the tree, takes in the pre-tokens
in front whose boundary could depend on the edited characters, splits the new text from there
until its boundaries fall back on old ones, and updates the sums above the changed leaves. Only
the new pre-tokens are encoded.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import slices, table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the tokenizer splits a text before encoding the parts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A pre-token depends on so many characters after its end at most.
AHEAD = 2
#: Pre-tokens of a leaf before the tree is dealt out anew.
LEAF = 32
#: Different pre-tokens whose counts a task remembers.
KNOWN = 500_000

# Personal data that the query edits out: kinds and patterns.
REDACTIONS = {
    "<email>": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "<phone>": r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}",
    "<secret>": r"(?:token|key|password|secret) ?[=:] ?\"[^\"\s]{8,}\"",
}


class Counter:
    """Tokens of pre-tokens, each encoded once."""

    def __init__(self, path: str = RANKS):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}
        self.split = regex.compile(PATTERN)

    def tokens(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        for piece in {p for p in pieces if p not in known}:
            known[piece] = len(self.encoding.encode_ordinary(piece))
        return [known[p] for p in pieces]


class TokenTree:
    """Segment tree over the pre-tokens of one text. A leaf holds the characters and tokens of one or
    more pre-tokens, after edits also none. When a leaf gets more than ``LEAF``, all are dealt out anew;
    their counts are known, so nothing is encoded for that."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter = text, counter
        pieces = counter.split.findall(text)
        self._deal([(len(p), n) for p, n in zip(pieces, counter.tokens(pieces))])
        self.encoded = 0

    def _deal(self, pieces: list[tuple[int, int]]) -> None:
        """A leaf for each pre-token."""
        self.width = 1 << max(0, (len(pieces) - 1).bit_length())
        self.leaves: list[list[tuple[int, int]]] = [[p] for p in pieces]
        self.leaves += [[] for _ in range(self.width - len(pieces))]
        sums = np.zeros((2 * self.width, 2), np.int64)
        for i, leaf in enumerate(self.leaves):
            if leaf:
                sums[self.width + i] = leaf[0]
        level = self.width
        while level > 1:
            sums[level // 2 : level] = sums[level : 2 * level : 2] + sums[level + 1 : 2 * level : 2]
            level //= 2
        self.chars, self.sums = sums[:, 0].tolist(), sums[:, 1].tolist()

    @property
    def total(self) -> int:
        return self.sums[1]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place >= begin + self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.width, begin

    def _set(self, leaf: int, pieces: list[tuple[int, int]]):
        self.leaves[leaf] = pieces
        node = leaf + self.width
        self.chars[node], self.sums[node] = sum(c for c, _ in pieces), sum(n for _, n in pieces)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def replace(self, start: int, end: int, text: str):
        """Put ``text`` in place of the characters from ``start`` to ``end``."""
        size = len(self.text)
        if not 0 <= start <= end <= size:
            raise ValueError(f"edit {start}:{end} is outside the text of {size} characters")
        new = self.text[:start] + text + self.text[end:]
        shift = len(new) - size
        if not self.text:
            self.__init__(new, self.counter)
            self.encoded = len(self.counter.split.findall(new))
            return
        # The first leaf that can depend on what is edited, and the boundary it begins at.
        first, scan = self._leaf_at(min(max(0, start - AHEAD - 1), size - 1))
        leaf, old = first, scan  # the next old leaf, and where it begins in the old text
        pieces, match = [], self.counter.split.match
        while scan < len(new):
            while leaf < self.width and (old < end or old + shift < scan):
                old += self.chars[leaf + self.width]
                leaf += 1
            if pieces and old >= end and scan == old + shift:
                break  # what follows is as it was
            found = match(new, scan)
            pieces.append(found[0])
            scan = found.end()
        else:
            leaf = self.width
        counts = self.counter.tokens(pieces)
        self.encoded += len(pieces)
        self.text = new
        known = [(len(p), n) for p, n in zip(pieces, counts)]
        if leaf == first:
            self._set(first, [*known, *self.leaves[first]])
        else:
            # As many leaves as before take the new pre-tokens, so that edits side by side do not pile up in one.
            places, taken = leaf - first, 0
            for other in range(first, leaf):
                upto = len(known) * (other - first + 1) // places
                if known[taken:upto] or self.leaves[other]:
                    self._set(other, known[taken:upto])
                taken = upto
        if len(self.leaves[first]) > LEAF or len(self.leaves[max(first, leaf - 1)]) > LEAF:
            self._deal([piece for pieces in self.leaves for piece in pieces])


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that put a kind in place of personal data: apart, in order."""
    found = [(m.start(), m.end(), kind) for kind, pattern in REDACTIONS.items() for m in regex.finditer(pattern, text)]
    out: list[tuple[int, int, str]] = []
    for start, end, kind in sorted(found):
        if not out or start >= out[-1][1]:
            out.append((start, end, kind))
    return out


def edited_counts(docs: DataFrame, keep: list[str], edits=redactions, path: str = RANKS) -> DataFrame:
    """Rows (``keep``, ``n_tokens``, ``n_edits``, ``n_pretokens``, ``n_encoded``, ``n_tokens_after``).

    ``edits`` gives the edits of a text as (start, end, new text), apart and in order of the text
    before any of them; they are applied from the last to the first. ``n_encoded`` is how many
    pre-tokens all edits together encoded again. A null text counts as empty; columns of these
    names are replaced. ``path`` is the vocabulary file on every machine.
    """
    names = ("n_tokens", "n_edits", "n_pretokens", "n_encoded", "n_tokens_after")
    keep = [c for c in keep if c not in names]
    frame = docs.select([f"`{c}`" for c in dict.fromkeys([*keep, "text"])])
    schema = T.StructType([f for f in frame.schema.fields if f.name in keep] + [T.StructField(n, T.LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in slices(batches, 1000):
            rows = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                changes = edits(text)
                if not changes:  # no tree is needed where nothing is edited
                    pieces = counter.split.findall(text)
                    total = sum(counter.tokens(pieces))
                    rows.append((total, 0, len(pieces), 0, total))
                    continue
                tree = TokenTree(text, counter)
                total, pieces = tree.total, sum(map(len, tree.leaves))
                for start, end, new in reversed(changes):
                    tree.replace(start, end, new)
                rows.append((total, len(changes), pieces, tree.encoded, tree.total))
            kept = [c for c in batch.schema.names if c in keep]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, *names])

    return frame.mapInArrow(run, schema)


def op7_edit_aware_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every row of ``documents`` before and after personal data is edited out."""
    return edited_counts(table(spark, sf_dir, "documents"), ["doc_id"])
