"""Exact top-k by inner product over buckets of vectors of like length.

Vectors are grouped into bands of length (eight to an octave) and bands are cut into buckets, which
are numbered from the longest vectors down. Queries travel in blocks and meet the buckets in rounds,
each with four times the buckets of the one before; after a round every query knows the k-th of its
best scores so far. No vector under that score can enter the result, so by the inequality of Cauchy
and Schwarz a bucket of largest length ``l`` matters to a query ``q`` only if ``|q| * l`` reaches it.
Inside a bucket the local cosine threshold, score / (|q| * l), chooses the way:

* length: only the bucket's vectors that are long enough for the score, which come first;
* coordinate: for the query's largest coordinates, a vector at that cosine must have its own
  coordinates within an interval; sorted coordinates count who lies inside before anyone is touched.

What is left is verified with exact products. A round emits at most k rows per query and bucket;
since thresholds come from a quarter of the vectors seen so far, it is some 4k per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odsflow.llm.clustering import scaled, usable
from odsflow.llm.common import table, written

#: Vectors of a bucket, and queries of a block, on average.
BUCKET = 4096
BLOCK = 512
#: Bands of length to an octave. Lengths are under 2 ** 31, so there are 249 bands at most.
BANDS = 8
#: Coordinates that are looked at, and what touching one vector singly costs against the matrix product.
FOCUS = 3
SINGLE = 8
#: Lower cosine thresholds give intervals that exclude almost nothing.
LEAST_COSINE = 0.5
#: Allowance for rounding of bounds.
SLACK = 1 + 1e-9
#: Rows of bands that are broadcast; more (many different numbers of dimensions) are joined.
MOST_BANDS = 20_000

#: Production parameters of the query.
K = 20
SCALE = 64
EVERY = 20

_HITS = "query bigint, query_id bigint, vec_id bigint, score bigint"
_HITS_ARROW = pa.schema([(n, pa.int64()) for n in ("query", "query_id", "vec_id", "score")])
_LAST = np.iinfo(np.int64).max


class Bucket:
    """Vectors of one bucket, the longest first, with sorted coordinates when they are asked for."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, vectors: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        self.ids, self.lengths, self.vectors = ids[order], lengths[order], vectors[order]
        self.floats = self.vectors.astype(np.float64)
        self.top = float(self.lengths[0])
        self._coordinates: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._by_id = np.argsort(self.ids, kind="stable")

    def own(self, query_id: int) -> np.ndarray:
        """Places of the vectors with the query's id."""
        sorted_ids = self.ids[self._by_id]
        return self._by_id[np.searchsorted(sorted_ids, query_id) : np.searchsorted(sorted_ids, query_id, "right")]

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Coordinate ``f`` of the vectors at length one, ascending, and their places."""
        if f not in self._coordinates:
            values = self.floats[:, f] / np.maximum(self.lengths, 1e-300)
            places = np.argsort(values, kind="stable")
            self._coordinates[f] = values[places], places
        return self._coordinates[f]

    def long_enough(self, least: float) -> int:
        """How many vectors have that length."""
        return int(np.searchsorted(-self.lengths, -least, "right"))

    def near(self, query: np.ndarray, length: float, cosine: float) -> tuple[int, int, list]:
        """Vectors within the interval of the most selective focus coordinate: count, coordinate, intervals."""
        unit = query / length
        found = []
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            q, cosine = float(unit[f]), min(cosine, 1.0)
            half = np.sqrt(max(0.0, (1 - q * q) * (1 - cosine * cosine)))
            low = -1.0 if q <= -cosine else q * cosine - half
            high = 1.0 if q >= cosine else q * cosine + half
            low, high = low - 1e-7, high + 1e-7
            values, _ = self.coordinate(int(f))
            start, end = np.searchsorted(values, low), np.searchsorted(values, high, "right")
            found.append((int(end - start), int(f), low, high, int(start), int(end)))
        found.sort()
        return found[0][0], found[0][1], found

    def inside(self, intervals: list) -> np.ndarray:
        """Places of the vectors that lie inside all intervals; the most selective comes first."""
        _, f, _, _, start, end = intervals[0]
        places = self.coordinate(f)[1][start:end]
        for _, f, low, high, _, _ in intervals[1:]:
            values = self.floats[places, f] / np.maximum(self.lengths[places], 1e-300)
            places = places[(values >= low) & (values <= high)]
        return places

    def best(self, k: int, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, thresholds: np.ndarray):
        """For each query: places and scores of its k best (ties to the smaller id) at or over its threshold."""
        exact = float(lengths.max(initial=0)) * self.top < 2**53  # then sums of products are exact as doubles too
        floats = vectors.astype(np.float64)
        by_length: list[tuple[int, int]] = []
        for n in range(len(ids)):
            threshold, length = thresholds[n], float(lengths[n])
            if threshold > length * self.top * SLACK:
                yield n, np.empty(0, np.int64), np.empty(0, np.int64)  # no vector is long enough
                continue
            reach = len(self.ids)
            if threshold > 0:
                reach = self.long_enough(threshold / (length * SLACK))
                cosine = threshold / (length * self.top * SLACK)
                if cosine >= LEAST_COSINE:
                    count, _, intervals = self.near(floats[n], length, cosine)
                    if count * SINGLE < reach:
                        places = self.inside(intervals)
                        scores = self.vectors[places] @ vectors[n]
                        yield n, *self._kept(k, places, scores, threshold, ids[n])
                        continue
            by_length.append((reach, n))
        by_length.sort()
        for start in range(0, len(by_length), 128):
            part = by_length[start : start + 128]
            reach, chosen = part[-1][0], [n for _, n in part]
            if exact:
                scores = (floats[chosen] @ self.floats[:reach].T).astype(np.int64)
            else:
                scores = vectors[chosen] @ self.vectors[:reach].T
            for row, n in enumerate(chosen):
                yield n, *self._kept(k, None, scores[row], thresholds[n], ids[n])

    def _kept(self, k, places, scores, threshold, query_id):
        keep = scores >= threshold
        own = self.own(query_id)
        if len(own):
            keep[own[own < len(keep)] if places is None else np.isin(places, own)] = False
        at = np.flatnonzero(keep)
        if len(at) > k:
            least = np.partition(scores[at], len(at) - k)[len(at) - k]
            at = at[scores[at] >= least]
            places_at = at if places is None else places[at]
            at = at[np.lexsort((self.ids[places_at], -scores[at]))[:k]]
        return (at if places is None else places[at]), scores[at]


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(rows, -1).astype(np.int64)


def _of(cell: pa.ListScalar, name: str) -> pa.Array:
    return cell.values.field(name)


def _met(batches, k: int):
    """Hits of rows (dims, bucket, vectors, queries): a bucket and a block of queries."""
    held, name = None, None
    for batch in batches:
        for row in range(batch.num_rows):
            this = (batch["dims"][row].as_py(), batch["bucket"][row].as_py())
            if this != name:
                cell = batch["vectors"][row]
                ids = _of(cell, "id").fill_null(_LAST).to_numpy(zero_copy_only=False)
                held, name = Bucket(ids, _of(cell, "length").to_numpy(), _matrix(_of(cell, "v"), len(ids))), this
            cell = batch["queries"][row]
            query, query_ids = _of(cell, "row").to_numpy(), _of(cell, "id").to_numpy()
            vectors, lengths = _matrix(_of(cell, "v"), len(query)), _of(cell, "length").to_numpy()
            thresholds = _of(cell, "threshold").to_numpy(zero_copy_only=False).astype(np.float64)
            thresholds = np.where(np.isnan(thresholds), -np.inf, thresholds)
            out = [[], [], [], []]
            for n, places, scores in held.best(k, query_ids, vectors, lengths, thresholds):
                for column, values in zip(out, (np.full(len(places), query[n]), np.full(len(places), query_ids[n]), held.ids[places], scores)):
                    column.append(values)
            if out[0]:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in out]
                columns[2] = pa.compute.if_else(pa.compute.equal(columns[2], _LAST), None, columns[2])
                yield pa.RecordBatch.from_arrays(columns, schema=_HITS_ARROW)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_BANDS else df


def _first(round_: int) -> int:
    return (4**round_ - 1) // 3


def top_k(vectors: DataFrame, k: int, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for every query row its ``k`` best among all rows.

    ``is_query`` is a condition on the columns of ``vectors``. Components become ``floor(scale * x)``;
    the score is their inner product. A row never meets rows of its own id; ties go to the
    smaller id, a null id comes last. Vectors that are null or hold null or non-finite components take
    no part, nor those that need more than 32 bits a component or 61 bits a squared length (scores
    would not fit a long), nor, as queries, rows without an id. Vectors meet only those with as many
    components. Fewer than ``k`` candidates give fewer rows, repeated query rows give theirs
    again, an empty table gives none. Other columns do not pass.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(is_query & F.col(f"`{id_col}`").isNotNull(), F.lit(False)).alias("asks"),
        F.col(f"`{vector_col}`").alias("v"),
    ).where(usable("v", scale, (1 << 31) - 1))
    rows = rows.withColumn("v", scaled("v", scale).cast("array<int>"))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("length", F.sqrt(squares)).where(F.col("length") < float(1 << 30) * 2**0.5)
    band = F.when(F.col("length") > 0, F.floor(F.log2("length") * BANDS)).otherwise(-1).cast("int")
    rows = written(rows.withColumns({"dims": F.size("v"), "band": band}), "search-rows")

    bands = rows.groupBy("dims", "band").agg(F.count("*").alias("n"), F.max("length").alias("top"), F.count_if("asks").alias("asking"))
    down = Window.partitionBy("dims").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    pieces = F.ceil(F.col("n") / BUCKET)
    blocks = F.greatest(F.lit(1), F.ceil(F.sum("asking").over(Window.partitionBy("dims")) / BLOCK))
    bands = bands.withColumns({"pieces": pieces, "first": F.coalesce(F.sum(pieces).over(down), F.lit(0)), "blocks": blocks})
    bands = written(bands.withColumn("end", F.col("first") + F.col("pieces")), "search-bands")
    last = bands.agg(F.max("end")).first()[0] or 0

    placed = rows.join(_small(bands.select("dims", "band", "pieces", "first", "blocks")), ["dims", "band"])
    spread = lambda salt, n: F.pmod(F.xxhash64(F.col("row"), F.lit(salt)), F.col(n))
    buckets = placed.groupBy("dims", (F.col("first") + spread(0, "pieces")).alias("bucket"))
    buckets = written(buckets.agg(F.collect_list(F.struct("id", "length", "v")).alias("vectors")), "search-buckets")
    queries = placed.where("asks").select("dims", spread(1, "blocks").alias("block"), "row", "id", "length", "v")
    queries = written(queries, "search-queries")
    reaches = bands.groupBy("dims").agg(F.collect_list(F.struct("top", "end")).alias("reaches"))

    best, round_ = None, 0
    while _first(round_) < last:
        if best is None:
            asking = queries.withColumn("threshold", F.lit(None).cast("double"))
        else:
            full = best.where(F.col("place") == k).select("query", F.col("score").cast("double").alias("threshold"))
            asking = queries.join(full, queries["row"] == full["query"], "left").drop("query")
        need = F.when(F.col("threshold") > 0, F.col("threshold") / F.col("length")).otherwise(0.0)
        packed = asking.groupBy("dims", "block").agg(
            F.min(need).alias("need"), F.collect_list(F.struct("row", "id", "length", "threshold", "v")).alias("queries")
        )
        packed = written(packed, "search-asking")
        # Every block goes to the buckets of this round that are long enough for one of its queries.
        reach = F.array_max(F.transform(F.filter("reaches", lambda b: b["top"] * SLACK >= F.col("need")), lambda b: b["end"]))
        targets = packed.select("dims", "block", "need").join(reaches, "dims").select("dims", "block", F.least(reach, F.lit(_first(round_ + 1))).alias("end"))
        targets = targets.where(F.col("end") > _first(round_))
        targets = targets.select("dims", "block", F.explode(F.sequence(F.lit(_first(round_)).cast("long"), F.col("end") - 1)).alias("bucket"))
        met = targets.join(packed.drop("need"), ["dims", "block"]).join(buckets, ["dims", "bucket"])
        found = met.select("dims", "bucket", "vectors", "queries").mapInArrow(lambda batches: _met(batches, k), _HITS)
        if best is not None:
            found = found.union(best.drop("place"))
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        best = written(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "search-best")
        round_ += 1
    if best is None:
        best = vectors.sparkSession.createDataFrame([], _HITS + ", place int")
    return best.select("query_id", F.col("place").cast("int").alias("rank"), "vec_id", "score")


def op11_norm_buckets(spark, sf_dir: str) -> DataFrame:
    """The 20 best scores of every vector of ``embeddings`` whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), K, F.col("vec_id") % EVERY == 0, scale=SCALE)


SQL = f"""
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
    SELECT q.n, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % {EVERY} = 0 AND c.vec_id IS DISTINCT FROM q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, (row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= {K}
"""
