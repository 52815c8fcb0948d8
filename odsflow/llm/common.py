"""What several operators share: tables, written intermediate results, words."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odsflow.sinks.paths import scratch

#: Bytes of words after lower-casing A-Z; everything else separates words.
WORD_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)


#: Rows that go to a Python worker at once. Rows are whole texts here, so Spark's 10,000 would hold
#: tens of megabytes, several times over in the JVM and the worker of every task.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder, to be read in batches that suit texts."""
    _small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    Later steps read what was written, so they neither repeat the work nor depend on
    any executor's memory or disk.
    """
    spark = df.sparkSession
    _small_batches(spark)
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of a text as UTF-8: runs of ASCII letters, digits and all other characters."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes of them stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, dict]]:
    """Groups of equal ``key`` in batches that are sorted by it: the key and its columns.

    Numbers come as arrays, lists of numbers of one length as matrices, all else as lists. Only
    the open group is kept between batches.
    """
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        if held is None or not held.num_rows:
            continue
        keys = held.column(key).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        bounds = [0, *cuts.tolist()] + ([held.num_rows] if batch is None else [])
        ready = held.slice(0, bounds[-1])
        columns = {name: _plain(ready.column(name)) for name in held.schema.names if name != key}
        for start, end in zip(bounds, bounds[1:]):
            yield keys[start].item(), {name: values[start:end] for name, values in columns.items()}
        held = held.slice(bounds[-1])


def _plain(column: pa.ChunkedArray):
    if pa.types.is_integer(column.type):
        return column.to_numpy()
    if pa.types.is_list(column.type):
        values = column.combine_chunks()
        flat = (values.chunk(0) if isinstance(values, pa.ChunkedArray) and values.num_chunks else values).flatten()
        return flat.to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, 1))
    return column.to_pylist()


def components(edges: DataFrame, name: str) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a, b): root is the least node it is connected to.

    Edges are rewritten to point at smaller and smaller nodes, in turn at all larger neighbours and
    at all smaller ones, until nothing changes; every round is written. A node with many edges
    meets its least neighbour in a sum per task and a join with one row per node.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        # Smaller neighbours of a node, and the node itself, are tied to the least of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        joined = edges.join(least, edges["a"] == least["u"])
        small = joined.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b").union(least)
        small = written(small.distinct(), name)
        # Larger neighbours of a node are tied to the least of all its neighbours.
        both = small.union(small.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = small.join(least, small["b"] == least["u"])
        edges = written(large.select("a", F.col("m").alias("b")).where("a <> b").distinct(), name)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
