"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own figures and those of the lines before and after
it; neighbouring labels are tied by transition weights. Forward-backward gives each line's
probability of being good, and their mean, weighted by line length, is the quality of the
document. The field is fitted on the driver, on a bounded sample of labelled documents of which
only the figures of lines are collected; everything else is one pass over the table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.llm.common import slices, table

#: Labelled documents the field is fitted on, at most.
SAMPLE_DOCS = 6000
#: Longest run of lines in fitting; longer documents are cut into several runs.
FIT_LINES = 32
THRESHOLD = 0.3
#: Figures of one line.
OWN = 14

# Classes of bytes.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&<>@^~=+_\\/{}[]",
    "bar": b"|",
    "shout": b"!",
    "sentence": b".,;:?'\"()-",
    "space": b" \t\r\v\f",
    "high": bytes(range(128, 256)),
}


@dataclass(frozen=True)
class Field:
    """Weights of the field: figures are scaled, then weighted into the odds of a good line."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transition: np.ndarray


def line_figures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Figures of all lines of all texts, the text of each line, and the bytes of each line."""
    lines = [text.split(b"\n") for text in texts]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in lines])
    flat = [line for x in lines for line in x]
    data = np.frombuffer(b"\n".join(flat) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    size = np.diff(np.concatenate([[-1], ends])) - 1
    starts = ends - size
    at = np.minimum(starts, len(data) - 1)
    share = {}
    kind = np.zeros(256, np.uint8)
    for number, members in enumerate(_CLASSES.values(), 1):
        kind[list(members)] = number
    kinds = kind[data]
    whole = np.maximum(size, 1)
    for number, name in enumerate(_CLASSES, 1):
        counts = np.add.reduceat((kinds == number).view(np.uint8), at, dtype=np.int64)
        share[name] = np.where(size > 0, counts, 0) / whole
    words = np.zeros(len(flat))
    distinct = np.zeros(len(flat))
    copies = np.zeros(len(flat))
    closed = np.zeros(len(flat))
    place = 0
    for x in lines:
        again = Counter(x) if len(x) > 1 else None
        for line in x:
            split = line.split()
            words[place] = len(split)
            distinct[place] = len(set(split))
            copies[place] = again[line] - 1 if again and split else 0
            closed[place] = line[-1:] in b".!?" and len(line) > 0
            place += 1
    letters = size * (1 - share["space"])
    own = np.column_stack(
        [
            np.log1p(size) / 8,
            np.log1p(words) / 6,
            np.minimum(letters / np.maximum(words, 1), 40) / 10,
            *(np.sqrt(share[name]) for name in ("upper", "digit", "symbol", "bar", "shout", "sentence", "high")),
            distinct / np.maximum(words, 1),
            copies > 0,
            np.log1p(copies),
            closed,
        ]
    ).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = owner[1:] == owner[:-1]
    before[1:][inner] = own[:-1][inner]
    after[:-1][inner] = own[1:][inner]
    return np.concatenate([own, before, after], axis=1), owner, size


def marginals(odds: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward on padded sequences of log odds of a good line.

    Gives each line's probability of good, the expected transitions (2 x 2, from and to), and the
    sum of the logarithms of the partition functions.
    """
    count, width = odds.shape
    move = np.exp(transition)
    emit = np.stack([np.ones_like(odds), np.exp(np.clip(odds, -30, 30))], axis=-1)
    forward, scale = np.empty((count, width, 2)), np.ones((count, width))
    for t in range(width):
        now = emit[:, t] if t == 0 else (forward[:, t - 1] @ move) * emit[:, t]
        total = now.sum(axis=1)
        forward[:, t] = now / total[:, None]
        scale[:, t] = total
    inside = np.arange(width)[None, :] < lengths[:, None]
    good, pairs = np.empty((count, width)), np.zeros((2, 2))
    backward = np.ones((count, 2))
    for t in range(width - 1, -1, -1):
        live = inside[:, t, None]
        both = forward[:, t] * np.where(live, backward, 1)
        good[:, t] = both[:, 1] / both.sum(axis=1)
        if t:
            ahead = emit[:, t] * np.where(live, backward, 1) / scale[:, t, None]
            pairs += move * (np.where(live, forward[:, t - 1], 0).T @ np.where(live, ahead, 0))
            backward = np.where(live, ahead @ move.T, 1)
    return good, pairs, float(np.log(scale)[inside].sum())


def _padded(figures: np.ndarray, owner: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``figures`` as (sequence, line, figure), and the length of each sequence."""
    lengths = np.bincount(owner)
    first = np.cumsum(lengths) - lengths
    out = np.zeros((len(lengths), most, figures.shape[1]), np.float32)
    out[owner, np.arange(len(owner)) - first[owner]] = figures
    return out, lengths


def fit(figures: np.ndarray, owner: np.ndarray, label: np.ndarray, rounds: int = 250, decay: float = 1e-3) -> Field:
    """The field of greatest likelihood (with a small penalty) by full-batch steps.

    ``owner`` numbers the document of each line, ``label`` gives the label of each document, which
    all its lines take.
    """
    mean, scale = figures.mean(axis=0), figures.std(axis=0) + 1e-3
    lengths = np.bincount(owner, minlength=len(label))
    inside = np.arange(len(owner)) - (np.cumsum(lengths) - lengths)[owner]
    _, run = np.unique(owner.astype(np.int64) * (1 << 32) + inside // FIT_LINES, return_inverse=True)
    truth = np.zeros(run.max() + 1)
    truth[run] = label[owner]
    x, sizes = _padded(np.clip((figures - mean) / scale, -6, 6), run, FIT_LINES)
    x = np.concatenate([x, np.ones((*x.shape[:2], 1), np.float32)], axis=2)
    x[np.arange(FIT_LINES)[None, :] >= sizes[:, None]] = 0
    observed = (x.sum(axis=1) * truth[:, None]).sum(axis=0)
    stays = np.maximum(sizes - 1, 0)
    seen = np.diag([(stays * (1 - truth)).sum(), (stays * truth).sum()])
    n = len(truth)
    params = np.zeros(x.shape[2] + 4)
    speed, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        weights, transition = params[:-4], params[-4:].reshape(2, 2)
        good, pairs, _ = marginals(x @ weights, sizes, transition)
        good[np.arange(FIT_LINES)[None, :] >= sizes[:, None]] = 0
        expected = np.einsum("st,std->d", good, x)
        slope = np.concatenate([expected - observed, (pairs - seen).ravel()]) / n + decay * params
        speed = 0.9 * speed + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        params = params - 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(mean, scale, params[:-4], params[-4:].reshape(2, 2))


def scores(texts: list[str | None], field: Field) -> np.ndarray:
    """Quality of each text, 0 to 1; 0 for a text without words."""
    data = [(text or "").encode("utf-8", "replace") for text in texts]
    out = np.zeros(len(data))
    if not data:
        return out
    figures, owner, size = line_figures(data)
    odds = np.clip((figures - field.mean) / field.scale, -6, 6) @ field.weights[:-1] + field.weights[-1]
    lengths = np.bincount(owner, minlength=len(data))
    first = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):  # texts of like length together, at most so many padded lines
        width, upto = int(lengths[order[at]]), at + 1
        while upto < len(order) and (upto + 1 - at) * lengths[order[upto]] <= max(200_000, lengths[order[upto]]):
            upto += 1
        mine = order[at:upto]
        width = int(lengths[mine].max())
        line = np.minimum(first[mine, None] + np.arange(width)[None, :], len(odds) - 1)
        inside = np.arange(width)[None, :] < lengths[mine, None]
        good, _, _ = marginals(np.where(inside, odds[line], 0), lengths[mine], field.transition)
        weight = np.where(inside, size[line], 0)
        out[mine] = (good * weight).sum(axis=1) / np.maximum(weight.sum(axis=1), 1)
        at = upto
    return np.where([bool(text.strip()) for text in data], out, 0.0)


def held_out(doc_id):
    """Whether a row is kept from fitting: crc32 of its id as text is divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> Field:
    """The field fitted on ``labels.quality`` of at most ``most`` documents, chosen by a hash of
    their id, none of them held out. Unlabelled rows (null) are not used; a document with several
    labels takes the smallest. Without any label every line is as likely good as bad.
    """
    chosen = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = chosen.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = "doc_id long, quality int, lines binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = [(text or "").encode("utf-8", "replace") for text in batch["text"]]
            figures, owner, _ = line_figures(data)
            lengths = np.bincount(owner, minlength=len(data))
            cut = np.split(figures, np.cumsum(lengths)[:-1])
            lines = [x.astype(np.float32).tobytes() for x in cut]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "lines": lines})

    # Repeats of a document are dropped before anything reaches the driver.
    rows = sample.mapInPandas(run, schema).groupBy("doc_id", "quality").agg(F.min("lines").alias("lines"))
    rows = rows.toPandas().sort_values("doc_id")
    width = 3 * OWN
    if rows.empty:
        return Field(np.zeros(width), np.ones(width), np.zeros(width + 1), np.zeros((2, 2)))
    figures = [np.frombuffer(x, np.float32).reshape(-1, width) for x in rows["lines"]]
    owner = np.repeat(np.arange(len(figures)), [len(x) for x in figures])
    return fit(np.concatenate(figures), owner, rows["quality"].to_numpy(float))


def classify(docs: DataFrame, field: Field, keep: list[str]) -> DataFrame:
    """Rows (``keep``, ``quality_score``) for every row of ``docs``; a text that is null, empty or
    blank scores 0. A column ``quality_score`` is replaced."""
    keep = [c for c in keep if c != "quality_score"]
    frame = docs.select([f"`{c}`" for c in dict.fromkeys([*keep, "text"])])
    schema = T.StructType([f for f in frame.schema.fields if f.name in keep] + [T.StructField("quality_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names = [c for c in batch.schema.names if c in keep]
            found = scores(batch.column("text").to_pylist(), field)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found, pa.float64())], names=[*names, "quality_score"]
            )

    return frame.mapInArrow(run, schema)


def good_only(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose quality is under the threshold."""
    scored = classify(docs, train(docs, labels), docs.columns)
    return scored.where(F.col("quality_score") >= THRESHOLD).select(docs.columns)


def op3_line_crf(spark, sf_dir: str) -> DataFrame:
    """Quality of every row of ``documents``, learnt from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    scored = classify(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
