"""Tables with one row per key: latest version, deletes and partial updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odsflow.operators.changes import DELETED


def latest_by_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str | Column]) -> DataFrame:
    """Row with the highest version of each key.

    An aggregate rather than a window: each task sends on one row per key, so a key that
    is rewritten all the time costs no more than another.
    """
    row = F.struct(*rows.columns)
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(row, F.struct(*version)).alias("row"))
        .select("row.*")
    )


def without_deleted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(DELETED) == 0).drop(DELETED)


def merge_changes(
    snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Snapshot with a batch of changes applied: upserts replace, deletes remove.

    The snapshot has one row per key. Only its keys that were changed have to give way, so
    it is filtered by an anti join against the changes and never grouped or sorted.
    """
    newest = latest_by_key(changes, keys, version)
    untouched = snapshot.join(changes.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(without_deleted(newest).select(*snapshot.columns))


def upsert(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Insert ``rows``; where the key exists, overwrite only the ``update`` columns
    (all but the keys when not given). ``rows`` has one row per key."""
    update = set(update if update is not None else [c for c in rows.columns if c not in keys])
    old = target.select(*keys, F.struct(*target.columns).alias("old"))
    new = rows.select(*keys, F.struct(*rows.columns).alias("new"))
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        incoming = F.col(f"new.{name}") if name in rows.columns else F.lit(None)
        takes_new = F.col("old").isNull()
        if name in update and name in rows.columns:
            takes_new = F.col("new").isNotNull()
        columns.append(F.when(takes_new, incoming).otherwise(F.col(f"old.{name}")).alias(name))
    return old.join(new, list(keys), "full_outer").select(*columns)
