"""Tie a table to the stream whose batch numbers it uses.

A batch number means something only together with the checkpoint that counts it. With another
checkpoint, batch 0 would replace the old batch 0, or be taken for one that is applied already.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from odsflow.sinks.paths import exists, numbered


class ForeignCheckpoint(RuntimeError):
    """The table belongs to the stream of another checkpoint."""


def claim(spark: SparkSession, path: str, checkpoint: str, batches: str) -> None:
    """Note the identity of the stream of ``checkpoint`` at ``path``, or check that it is the one noted.

    ``batches`` is the folder of the table's batches: where it holds any without a note, nobody
    knows whose numbers they are, and they are not touched.
    """
    stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    note = f"{path}/_owner"
    if not exists(spark, f"{note}/_SUCCESS"):
        if numbered(spark, batches, "batch_id", complete=False):
            raise ForeignCheckpoint(f"{batches} holds batches of an unknown stream")
        spark.createDataFrame([(stream,)], "stream string").coalesce(1).write.mode("overwrite").parquet(note)
    owner = spark.read.parquet(note).first().stream
    if owner != stream:
        raise ForeignCheckpoint(f"{path} belongs to stream {owner}, not to {stream} of {checkpoint}")
