"""Message positions: gaps in topics, and counts over a span of positions.

Positions are cut into blocks, so that a topic partition, which may hold billions of messages, is
never ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a block.
BLOCK = 1 << 20
PARTITION = ("topic", "partition")


def _block(size: int) -> Column:
    return F.floor(F.col("offset") / size)


def extents(messages: DataFrame, keys: Sequence[str] = PARTITION) -> DataFrame:
    """First and last offset of every partition of the messages."""
    return messages.groupBy(*keys).agg(F.min("offset").alias("first"), F.max("offset").alias("last"))


def missing_offsets(
    messages: DataFrame, after: DataFrame | None = None, keys: Sequence[str] = PARTITION, block: int = BLOCK
) -> DataFrame:
    """Rows (keys, first_missing, last_missing): the gaps in the offsets of each partition.

    ``after`` has the last offset (``last``) that was seen before, by partition: what lies between it
    and the messages is missing too, and messages that are no newer are left out. Repeated messages do
    no harm. Blocks are summed up first; only those with a gap inside are looked into.
    """
    keys = list(keys)
    offsets = messages.where(F.col("offset").isNotNull()).select(*keys, "offset", _block(block).alias("block"))
    if after is not None:
        known = F.broadcast(after.select(*keys, "last"))  # a row per partition of a topic
        offsets = offsets.join(known, keys, "left").where(F.col("last").isNull() | (F.col("offset") > F.col("last"))).drop("last")
    blocks = offsets.groupBy(*keys, "block").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.countDistinct("offset").alias("n")
    )
    # Between blocks: a row per block.
    ends = blocks.select(*keys, "first", "last")
    if after is not None:
        seen = F.col("last")
        ends = ends.unionByName(after.select(*keys, seen.alias("first"), seen.alias("last")))
    before = Window.partitionBy(*keys).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("seen", F.max("last").over(before))
    between = ends.where(F.col("first") > F.col("seen") + 1)
    between = between.select(*keys, (F.col("seen") + 1).alias("first_missing"), (F.col("first") - 1).alias("last_missing"))
    # Inside blocks.
    gapped = blocks.where(F.col("n") < F.col("last") - F.col("first") + 1).select(*keys, "block")
    inside = offsets.join(gapped, [*keys, "block"], "left_semi").distinct()
    following = F.lag("offset").over(Window.partitionBy(*keys, "block").orderBy("offset"))
    inside = inside.withColumn("seen", following).where(F.col("offset") > F.col("seen") + 1)
    inside = inside.select(*keys, (F.col("seen") + 1).alias("first_missing"), (F.col("offset") - 1).alias("last_missing"))
    return between.unionByName(inside)


def count_in_span(rows: DataFrame, span: int, keys: Sequence[str] = ("partition",)) -> DataFrame:
    """``rows`` with ``in_span``: how many of them have an offset within the last ``span`` offsets, their own
    included.

    Every row also goes to the next block as context, where it counts and is not returned, so a task
    orders the rows of two blocks at most.
    """
    keys, columns = list(keys), rows.columns
    here = rows.withColumn("block", _block(span)).withColumn("context", F.lit(False))
    there = here.withColumns({"block": F.col("block") + 1, "context": F.lit(True)})
    last = Window.partitionBy(*keys, "block").orderBy("offset").rangeBetween(-(span - 1), 0)
    counted = here.unionByName(there).withColumn("in_span", F.count(F.lit(1)).over(last))
    return counted.where(~F.col("context")).select(*columns, "in_span")
