"""Keyed table on plain files: a snapshot and the changes since, merged by a join on reading.

A micro-batch appends its changes; nothing is rewritten for it. Readers take the snapshot, drop the
keys that changed by an anti join, and add the last change of each (``operators/keyed.py``). A
scheduled job writes what readers see as the next snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odsflow.operators.changes import DELETED
from odsflow.operators.keyed import latest_by_key, merge_changes
from odsflow.sinks.append import BATCH, append_batch
from odsflow.sinks.paths import numbered, remove

#: Order of changes: batches first, then position in the topic. A key always lands in the
#: same topic partition, so this is the order in which its changes were made.
ORDER = (BATCH, "partition", "offset")

_UPTO = "upto"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str):
        self.spark, self.schema, self.key = spark, schema, key
        self.log, self.snapshots = f"{path}/log", f"{path}/snapshot"
        more = {DELETED: T.IntegerType(), "partition": T.IntegerType(), "offset": T.LongType(), BATCH: T.LongType()}
        self._log_schema = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in more.items()]])

    def load(self, snapshot: DataFrame) -> None:
        """Fill a new table from a snapshot."""
        if self._upto() is not None or self._batches(None):
            raise ValueError(f"{self.log} and {self.snapshots} hold a table already")
        self._write(snapshot, -1)

    def append(self, changes: DataFrame, batch_id: int, checkpoint: str | None = None) -> None:
        """Keep the changes of one batch, the last one of each key. A batch that is replayed
        replaces itself. With ``checkpoint`` the table is tied to its stream."""
        newest = latest_by_key(changes, [self.key], ["partition", "offset"])
        append_batch(newest, self.log, batch_id, [c for c in self._log_schema.fieldNames() if c != BATCH], checkpoint=checkpoint)

    def read(self) -> DataFrame:
        """Current rows."""
        upto = self._upto()
        return self._merged(upto, self._batches(upto))

    def fold(self) -> int | None:
        """Write the current rows as the next snapshot, if there are changes since the last one. It is named
        after the last batch that it holds; batches that arrive meanwhile stay in the log."""
        upto = self._upto()
        batches = self._batches(upto)
        if not batches:
            return None
        self._write(self._merged(upto, batches), batches[-1])
        return batches[-1]

    def drop_folded(self) -> None:
        """Remove old snapshots and the batches that are in the newest. Not while older readers still run."""
        upto = self._upto()
        for folder, label in ((self.snapshots, _UPTO), (self.log, BATCH)):
            for number in numbered(self.spark, folder, label, complete=False):
                if upto is not None and (number < upto or number == upto and label == BATCH):
                    remove(self.spark, f"{folder}/{label}={number}")

    def _upto(self) -> int | None:
        """Last batch that the newest complete snapshot holds; -1 for a table that was loaded."""
        found = numbered(self.spark, self.snapshots, _UPTO)
        return found[-1] if found else None

    def _batches(self, after: int | None) -> list[int]:
        """Complete batches after a snapshot: one that is being written is not read by half."""
        return [b for b in numbered(self.spark, self.log, BATCH) if after is None or b > after]

    def _merged(self, upto: int | None, batches: list[int]) -> DataFrame:
        snapshot = self.spark.createDataFrame([], self.schema)
        if upto is not None:
            snapshot = self.spark.read.schema(self.schema).parquet(f"{self.snapshots}/{_UPTO}={upto}")
        if not batches:
            return snapshot
        reader = self.spark.read.schema(self._log_schema).option("basePath", self.log)
        changes = reader.parquet(*[f"{self.log}/{BATCH}={b}" for b in batches])
        return merge_changes(snapshot, changes, [self.key], ORDER)

    def _write(self, rows: DataFrame, upto: int) -> None:
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        typed.write.mode("overwrite").parquet(f"{self.snapshots}/{_UPTO}={upto}")
