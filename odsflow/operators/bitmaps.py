"""Exact distinct counts that add up: ids kept as bitmaps.

A distinct count cannot be added to another one, as both may have counted the same id. A bitmap
can be merged, so a table per hour answers for any day, month or range of hours. An id is a bucket
number and one of the 64 bits of a whole number. Every bucket is a row of its own: a group with very
many ids is spread over as many rows as it needs, and merging it is never one task's work alone.

Whole numbers are merged in a hash aggregate. Spark's own bitmaps of 4 KB are not: their rows are
sorted, with 4 KB for every id where the ids of an hour lie far apart, and a task that reads some
megabytes of compressed ones holds gigabytes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHAT, BUCKET, BITS = "what", "bucket", "bits"


def id_bitmaps(rows: DataFrame, keys: Sequence[str], ids: Mapping[str, str]) -> DataFrame:
    """Rows (keys, what, bucket, bits): for each group the ids of several columns as bitmaps.

    ``ids`` maps a name to the integer column whose values are kept under it. Null ids are not
    counted, as in a distinct count. All columns are read in one scan; only (keys, id) is grouped.
    """
    named = [F.struct(F.lit(name).alias(WHAT), F.col(column).cast("long").alias("id")) for name, column in ids.items()]
    long = rows.select(*keys, F.inline(F.array(*named))).where(F.col("id").isNotNull())
    bit = F.expr("shiftleft(1L, CAST(id & 63 AS INT))")
    return long.groupBy(*keys, WHAT, F.shiftright("id", 6).alias(BUCKET)).agg(F.bit_or(bit).alias(BITS))


def merged(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same ids under fewer keys."""
    return bitmaps.groupBy(*keys, WHAT, BUCKET).agg(F.bit_or(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Number of distinct ids of each name, one column per name, by ``keys`` (one row if there are none)."""
    counted = merged(bitmaps, keys).select(*keys, WHAT, F.bit_count(BITS).alias("n"))
    columns = [F.coalesce(F.sum(F.when(F.col(WHAT) == name, F.col("n"))), F.lit(0)).alias(name) for name in names]
    return counted.groupBy(*keys).agg(*columns)
