"""Rounds of nearest-centroid assignment over vectors that are stored by dictionary codes.

Vectors are packed into chunks. Of every chunk, each block of ``width`` neighbouring dimensions is
encoded without loss: a dictionary of the distinct subvectors that occur, and one code per vector.
A round then computes the exact distance of every dictionary entry to every centroid once, and a
vector's distance is the sum of the entries that its codes name. The sums of a cluster come from
the codes too: an entry counts as often as the cluster's vectors name it.

Chunks stay where they were written, so a round shuffles one row per task, cluster and dimension;
the driver sees the centroids and the sums of each cluster, which the number of clusters bounds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odsflow.llm.common import table, written

#: Vectors of one chunk; fewer than 65,536, so that a code is a 16-bit number.
CHUNK = 16_384
#: Neighbouring dimensions that share a dictionary.
WIDTH = 2
#: Largest size of a component after scaling: squared distances of any vectors then fit a long.
LARGEST = 1 << 24

#: Production parameters of the query.
CLUSTERS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
SEED = 1

_CHUNKS = "ids array<bigint>, codes binary, words array<binary>"
_SUMS = "cluster int, dim int, total bigint"
_ASSIGNED = "id bigint, cluster int, distance bigint"


def scaled(vector: str, scale: int) -> Column:
    """Components of ``vector`` as ``floor(scale * x)``."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: str, scale: int, largest: int) -> Column:
    """Whether ``vector`` is there, without null or non-finite components or such that leave ±``largest``."""
    fits = lambda x: F.coalesce(F.abs(x.cast("double")) * scale <= F.lit(float(largest)), F.lit(False))
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: fits(x) & ~F.isnan(x.cast("double")))


def _blocks(dimensions: int, width: int) -> list[slice]:
    return [slice(start, min(start + width, dimensions)) for start in range(0, dimensions, width)]


def _encode(vectors: np.ndarray, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes (vectors by blocks) and the dictionary of each block."""
    blocks = _blocks(vectors.shape[1], width)
    codes, words = np.empty((len(vectors), len(blocks)), np.uint16), []
    for number, block in enumerate(blocks):
        part = np.ascontiguousarray(vectors[:, block])
        entries, names = np.unique(part.view(np.dtype((np.void, part.dtype.itemsize * part.shape[1]))).ravel(), return_inverse=True)
        codes[:, number] = names.ravel()
        words.append(entries.view(np.int64).reshape(len(entries), part.shape[1]))
    return codes, words


def _packed(batches, dimensions: int, width: int):
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("codes", pa.binary()), ("words", pa.list_(pa.binary()))])

    def chunk(held):
        rows = pa.Table.from_batches(held).combine_chunks()
        flat = rows.column("vector").combine_chunks().flatten().to_numpy()
        codes, words = _encode(flat.reshape(-1, dimensions).astype(np.int64), width)
        row = {"ids": rows.column("id").to_pylist(), "codes": codes.tobytes(), "words": [w.tobytes() for w in words]}
        return pa.RecordBatch.from_pylist([row], schema)

    held, count = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            if count + part.num_rows > CHUNK:
                yield chunk(held)
                held, count = [], 0
            held.append(part)
            count += part.num_rows
    if count:
        yield chunk(held)


def _nearest(row: dict, centroids: np.ndarray, width: int):
    """Cluster and squared distance of every vector of a chunk; its codes and dictionaries."""
    blocks = _blocks(centroids.shape[1], width)
    codes = np.frombuffer(row["codes"], np.uint16).reshape(-1, len(blocks))
    words = [np.frombuffer(w, np.int64).reshape(-1, b.stop - b.start) for w, b in zip(row["words"], blocks)]
    total = np.zeros((len(codes), len(centroids)), np.int64)
    for number, (entries, block) in enumerate(zip(words, blocks)):
        apart = ((entries[:, None, :] - centroids[None, :, block]) ** 2).sum(2)
        total += apart[codes[:, number]]
    cluster = total.argmin(1)  # the first of equals
    return cluster, total[np.arange(len(codes)), cluster], codes, words, blocks


def _sums(batches, centroids: np.ndarray, width: int):
    """Per task: the sum of every dimension of every cluster, and its count as dimension -1."""
    k, dimensions = centroids.shape
    sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            cluster, _, codes, words, blocks = _nearest(row, centroids, width)
            counts += np.bincount(cluster, minlength=k)
            for number, (entries, block) in enumerate(zip(words, blocks)):
                named = np.bincount(cluster * len(entries) + codes[:, number], minlength=k * len(entries))
                sums[:, block] += named.reshape(k, -1) @ entries
    there = np.flatnonzero(counts)
    if len(there):
        values = np.concatenate([counts[there, None], sums[there]], axis=1)
        columns = [np.repeat(there, dimensions + 1), np.tile(np.arange(-1, dimensions), len(there)), values.ravel()]
        kinds = [pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["cluster", "dim", "total"])


def _assigned(batches, centroids: np.ndarray, width: int):
    for batch in batches:
        for row in batch.to_pylist():
            cluster, distance, *_ = _nearest(row, centroids, width)
            columns = [pa.array(row["ids"], pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])


def _moved(chunks: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Centroids after one round; those without vectors stay."""
    parts = chunks.mapInArrow(lambda batches: _sums(batches, centroids, width), _SUMS)
    totals = parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {(r["cluster"], r["dim"]): int(r["total"]) for r in totals.collect()}  # clusters by dimensions
    moved = centroids.copy()
    for cluster in range(len(centroids)):
        if count := found.get((cluster, -1)):
            moved[cluster] = [found[cluster, d] // count for d in range(centroids.shape[1])]
    return moved


def cluster(
    vectors: DataFrame, clusters: int, rounds: int, dimensions: int, *, id_col: str = "vec_id",
    vector_col: str = "embedding", scale: int = 64, seed: int = 1, width: int = WIDTH,
) -> DataFrame:
    """Rows (id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every usable vector.

    Components become ``floor(scale * x)``. Vectors that are null, have not ``dimensions``
    components, or hold one that is null, not finite or of a size over ``LARGEST`` (distances would not
    fit a long) take no part. The first centroids are the vectors with the least sha256 of
    ``seed:id``; a null id comes last, and rows of equal id follow in the order of their vectors. With
    fewer vectors than ``clusters`` there are fewer centroids. Repeated rows are vectors of their own.
    No usable vector gives no rows. Sums that no long can hold are null. Other columns do not pass.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    rows = rows.where((F.size("vector") == dimensions) & usable("vector", scale, LARGEST))
    rows = rows.select("id", scaled("vector", scale).alias("vector"))
    chunks = written(rows.mapInArrow(lambda batches: _packed(batches, dimensions, width), _CHUNKS), "cluster-chunks")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.orderBy(name.asc_nulls_last(), "vector").limit(clusters).collect()
    if not first:
        first = [{"vector": [0] * dimensions}]
    centroids = np.array([list(r["vector"]) for r in first], np.int64)
    for _ in range(rounds):
        centroids = _moved(chunks, centroids, width)
    assigned = written(chunks.mapInArrow(lambda batches: _assigned(batches, centroids, width), _ASSIGNED), "clusters")

    # A row per cluster.
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    long = lambda n: n if n < 1 << 63 else None
    inertia = long(sum(int(r["s"]) for r in sums))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(r["cluster"], long(int(r["s"])), inertia, digest[r["cluster"]]) for r in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(facts), "cluster")  # at most ``clusters`` rows
    return joined.select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_subvector_dictionaries(spark, sf_dir: str) -> DataFrame:
    """Clusters of all ``embeddings``."""
    found = cluster(table(spark, sf_dir, "embeddings"), CLUSTERS, ROUNDS, DIMENSIONS, scale=SCALE, seed=SEED)
    return found.withColumnRenamed("id", "vec_id")


def _sql() -> str:
    rounds = []
    for r in range(ROUNDS + 1):
        rounds.append(f"""
apart{r} AS (
    SELECT v.n, c.cluster, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
    FROM vectors v, centroids{r} c),
near{r} AS MATERIALIZED (
    SELECT n, cluster, distance FROM apart{r}
    QUALIFY row_number() OVER (PARTITION BY n ORDER BY distance, cluster) = 1)""")
        if r < ROUNDS:
            rounds.append(f"""
means{r} AS (
    SELECT cluster, list(x ORDER BY d) AS v FROM (
        SELECT cluster, d, (CASE WHEN s >= 0 THEN s // c ELSE -((c - 1 - s) // c) END)::BIGINT AS x FROM (
            SELECT cluster, d, sum(v[d])::BIGINT AS s, count(*) AS c
            FROM near{r} JOIN vectors USING (n), range(1, {DIMENSIONS + 1}) t(d) GROUP BY cluster, d))
    GROUP BY cluster),
centroids{r + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(m.v, c.v) AS v FROM centroids{r} c LEFT JOIN means{r} m USING (cluster))""")
    return f"""
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = {DIMENSIONS}
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
centroids0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR) NULLS LAST, v) - 1)::INTEGER AS cluster, v
    FROM vectors QUALIFY cluster < {CLUSTERS}),{",".join(rounds)}
SELECT vec_id, cluster, distance,
    sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near{ROUNDS} JOIN vectors USING (n) JOIN centroids{ROUNDS} c USING (cluster)
"""


SQL = _sql()
