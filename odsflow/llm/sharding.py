"""Shards that all hold the same mixture of sources.

Rows of each source are shuffled by a seeded hash and numbered. Row ``r`` of ``n`` gets the
fraction ``(2r - 1) / 2n``; sorting all rows by fraction interleaves the sources in proportion,
and cutting that order into equal runs gives shards whose row counts differ by one at most.

Numbering needs no source, and no sorted table, in one task: rows are dealt into small ranges of
the hash (then of the fraction), counted per range, and numbered inside a range after the number
of rows in earlier ranges. A key that alone has more rows than a range is dealt over ranges of its
own, which stand where the key stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odsflow.llm.common import table, written

#: Rows that one range holds on average.
RANGE_ROWS = 4096

#: Production parameters of the query.
SHARDS = 24
SEED = 20240117


def _shuffle_key(columns: list[str], seed: int) -> Column:
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *parts))


def _split_hot_keys(dealt: DataFrame) -> DataFrame:
    """Rows of hash ranges with ``floor`` and ``part``, which cut a range where it holds a hot key.

    ``floor`` is the greatest hot key up to the row's own ('' before all of them). Rows of that key
    are dealt over parts; rows after it are the last part.
    """
    hot = dealt.groupBy("source", "range", "key").agg(F.count("*").alias("n")).where(F.col("n") > RANGE_ROWS)
    # At most one row for each RANGE_ROWS rows of the table.
    hot = written(hot, "hot_keys")
    if hot.isEmpty():
        return dealt.withColumns({"floor": F.lit(""), "part": F.lit(0).cast("long")})
    hot = hot.groupBy("source", "range").agg(F.collect_list(F.struct("key", "n")).alias("hot"))
    up_to = F.array_max(F.filter(F.coalesce("hot", F.array()), lambda h: h["key"] <= F.col("key")))
    cut = dealt.join(hot, ["source", "range"], "left").withColumn("up_to", up_to)
    parts = F.expr(f"up_to.n div {RANGE_ROWS} + 1")
    part = F.when(F.col("up_to.key") == F.col("key"), F.pmod("number", parts)).otherwise(F.coalesce(parts, F.lit(0)))
    return cut.withColumns({"floor": F.coalesce("up_to.key", F.lit("")), "part": part.cast("long")}).drop("hot", "up_to")


def interleave(docs: DataFrame, shards: int, stratum: str, ids: list[str], seed: int = 0) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (its place in the shard, from 0).

    ``stratum`` names the column whose mixture every shard repeats; null is a source like any
    other. ``ids`` name the columns that decide the shuffled order; rows equal in all of them are
    interchangeable and get places of their own. An empty table gives an empty table. Existing
    columns ``shard`` and ``slot`` are replaced; all others pass through.
    """
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    source = F.coalesce(F.concat(F.lit("s"), F.col(f"`{stratum}`").cast("string")), F.lit("n"))
    # The number of a row deals equal rows over ranges; it is written, so that it is the same on every reading.
    number = F.monotonically_increasing_id().alias("number")
    rows = written(docs.select(source.alias("source"), _shuffle_key(ids, seed).alias("key"), number, row.alias("row")), "interleave")
    total = rows.count()
    ranges = total // RANGE_ROWS + 1

    hashed = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    dealt = rows.withColumn("range", F.floor(hashed * ranges / F.lit(1 << 32)))
    places = ["range", "floor", "part"]
    dealt = _split_hot_keys(dealt)
    before = Window.partitionBy("source").orderBy(*places).rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("source", *places).agg(F.count("*").alias("n"))
    sizes = counts.groupBy("source").agg(F.sum("n").alias("size"))
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).join(sizes, "source").drop("n")
    inside = Window.partitionBy("source", *places).orderBy("key")
    ranked = dealt.withColumn("rank", F.row_number().over(inside)).join(offsets, ["source", *places])
    rank = F.col("rank") + F.col("offset")
    placed = ranked.select("source", "key", "row", ((2 * rank - 1).cast("double") / (2 * F.col("size"))).alias("fraction"))
    placed = placed.withColumn("range", F.floor(F.col("fraction") * ranges))

    starts = placed.groupBy("range").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("range").orderBy("fraction", "source", "key")
    numbered = placed.withColumn("place", F.row_number().over(inside)).join(starts, "range")
    total_or_one = max(total, 1)
    numbered = numbered.select("row", (F.col("place") + F.col("offset") - 1).alias("place"))
    numbered = numbered.withColumn("shard", F.expr(f"(place * {shards}) div {total_or_one}"))
    first = F.expr(f"(shard * {total_or_one} + {shards - 1}) div {shards}")
    columns = [F.col("row").getField(c).alias(c) for c in keep]
    return numbered.select(*columns, F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"))


def op9_stratified_interleave(spark, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 of ``documents``, each with the mixture of sources of the whole table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = interleave(docs, SHARDS, "source", ["doc_id", "size", "text_crc32"], SEED)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def _crc_table() -> str:
    """SQL for the 256 steps of the reflected polynomial 0xEDB88320."""
    table = "range(256)"
    for _ in range(8):
        table = f"list_transform({table}, lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return table


SQL = f"""
WITH codes AS MATERIALIZED (SELECT {_crc_table()} AS t),
bytes AS (
    SELECT doc_id, coalesce(source, '') AS source, source IS NULL AS no_source, source AS source_out,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda y: ('0x' || y)::BIGINT) AS b
    FROM documents),
sized AS (
    SELECT doc_id, source_out, len(b)::BIGINT + 8 AS size,
        xor(coalesce(list_reduce(b, lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), 4294967295), 4294967295),
            4294967295)::BIGINT AS text_crc32,
        CASE WHEN no_source THEN 'n' ELSE 's' || source END AS stratum
    FROM bytes, codes),
shuffled AS (
    SELECT *, md5(concat_ws(chr(31), '{SEED}', coalesce(doc_id::VARCHAR, ''), size::VARCHAR, text_crc32::VARCHAR)) AS k
    FROM sized),
ranked AS (
    SELECT *, (2 * row_number() OVER (PARTITION BY stratum ORDER BY k) - 1)::DOUBLE
        / (2 * count(*) OVER (PARTITION BY stratum)) AS fraction
    FROM shuffled),
placed AS (
    SELECT *, row_number() OVER (ORDER BY fraction, stratum, k) - 1 AS place, count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, place * {SHARDS} // total AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
    (place - (shard * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard,
    source_out AS source
FROM cut
"""
