"""Joins of a large table to tables that hold one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Bytes in memory for a byte of compressed columnar files, as an upper estimate; a hint overrides Spark's own check of
#: the size, so it has to be on the safe side.
EXPANSION = 8


def scan_bytes(df: DataFrame) -> int | None:
    """Bytes of all files and local rows below ``df``, from the statistics of its plan.

    None when the plan cannot be inspected. For a table with one row per key, built
    by projections, filters and joins that keep that key, this bounds what a
    broadcast would ship, up to the compression of the files.
    """
    if not hasattr(df, "_jdf"):  # Spark Connect keeps plans on the server
        return None
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is known to be under ``spark.sql.autoBroadcastJoinThreshold`` once it is read."""
    size = scan_bytes(df)
    if size is None:
        return False
    return size * EXPANSION <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``fact`` to ``dim``, which has one row per ``key``.

    A small ``dim`` is broadcast. A large one goes through a shuffle, where adaptive
    execution splits the partitions of hot keys (and of null keys) on the fact side;
    that is allowed for both inner and left joins.
    """
    return fact.join(F.broadcast(dim) if fits_broadcast(dim) else dim, key, how)
