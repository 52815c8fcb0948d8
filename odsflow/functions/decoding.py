"""JSON decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def once(value: Column, name: str) -> Column:
    """``value`` as column ``name``, computed a single time per row.

    A filter on a computed column is moved below it and computes the value again. Filters do
    not move below a generated column, and a generator over a one-element array gives each
    row once.
    """
    return F.explode(F.array(value)).alias(name)


def decode_once(text: str | Column, schema: T.StructType, name: str) -> Column:
    """Decoded JSON as column ``name``. Without ``once``, each field that a filter tests would
    parse the text again."""
    return once(F.from_json(text, schema), name)
