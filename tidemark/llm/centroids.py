"""Exact integer k-means with equal-average equal-variance nearest-centroid search.

Vectors become whole numbers once, written as fixed-width binary. In a round each task searches the centroids sorted by
component sum, outwards from the vector's own sum. Two inequalities save distances (s: component sum, v: length of the
vector minus its mean, d: dimensions)::

    distance >= (s_x - s_c)^2 / d          nothing farther out on this side can win: the side ends
    distance >= (v_x - v_c)^2              this centroid cannot win: it is skipped

Only strictly worse centroids are left out, so ties reach the exact comparison and the smaller number wins. Tasks send
one row of sums a centroid, Spark adds them up, and the driver divides k * d whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import quoted, written

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
#: Largest whole component: every square and sum of the search then stays below 2^63 (up to 64 dimensions).
LARGEST = 1 << 24
#: Vectors searched at once; a task holds one such block.
BLOCK_ROWS = 4096


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) as whole numbers; an error beyond ``LARGEST``, where squared distances leave 64 bits."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}")
    return scaled.astype(np.int32)


def kept_vectors(vectors: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v): key and whole components (32 bit, little-endian) of the rows with ``dims`` components, none null or non-finite."""
    src = vectors.select(F.col(quoted(key)).alias("id"), F.col(quoted(vector)).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lists = lists.cast(pa.list_(lists.type.value_type)) if not pa.types.is_list(lists.type) else lists
            right = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(lists), dims), False))
            some = batch.filter(pa.array(right))
            flat = some.column(1).flatten()
            sound = np.asarray(pc.fill_null(pc.is_finite(flat.cast(pa.float64())), False)).reshape(-1, dims).all(axis=1)
            values = np.asarray(flat.cast(pa.float64()).fill_null(0.0)).reshape(-1, dims)[sound]
            packed = whole(values, scale).astype("<i4")
            rows = [r.tobytes() for r in packed]
            yield pa.RecordBatch.from_arrays([some.column(0).filter(pa.array(sound)), pa.array(rows, pa.binary())], ["id", "v"])

    return src.mapInArrow(run, T.StructType([src.schema["id"], T.StructField("v", T.BinaryType())]))


def first_centroids(kept: DataFrame, dims: int, k: int) -> np.ndarray:
    """The vectors with the k smallest sha256 of ``2:<id>``, in that order; equal ids in order of their components."""
    digest = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)
    rows = kept.where("id is not null").select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([np.frombuffer(r["v"], "<i4") for r in rows], np.int64).reshape(-1, dims)


class Search:
    """Nearest centroids of blocks of vectors."""

    def __init__(self, centroids: np.ndarray):
        self.dims = centroids.shape[1]
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.c = centroids[self.number]
        self.s = sums[self.number]
        self.v = self._deviation(self.c, self.s)

    def _deviation(self, x: np.ndarray, s: np.ndarray) -> np.ndarray:
        return np.sqrt((self.dims * (x * x).sum(axis=1) - s * s) / self.dims)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(centroid, squared distance) of each row of whole numbers, and how many distances were worked out."""
        n, k, far = len(x), len(self.c), np.iinfo(np.int64).max
        s = x.sum(axis=1)
        v = self._deviation(x, s)
        best, who = np.full(n, far), np.full(n, k)
        right = np.searchsorted(self.s, s)
        left = right - 1
        active, worked = np.arange(n), 0
        while len(active):
            lo, hi, at = left[active], right[active], s[active]
            gap_lo = np.where(lo >= 0, np.abs(at - self.s[np.maximum(lo, 0)]), far)
            gap_hi = np.where(hi < k, np.abs(at - self.s[np.minimum(hi, k - 1)]), far)
            go_left = gap_lo <= gap_hi
            gap = np.where(go_left, gap_lo, gap_hi)
            # the nearer side has nothing left or is too far: so is the other one
            open_ = gap < far
            known = best[active] < far
            open_ &= ~known | (np.where(open_, gap, 0) ** 2 <= self.dims * np.where(known, best[active], 0))
            active, go_left, lo, hi, known = active[open_], go_left[open_], lo[open_], hi[open_], known[open_]
            candidate = np.where(go_left, lo, hi)
            left[active] -= go_left
            right[active] += ~go_left
            # rounding of the square roots must not reject a tie
            apart = np.abs(v[active] - self.v[candidate]) * (1 - 1e-9) - 1e-3
            near = ~known | (apart < 0) | (apart * apart <= best[active])
            rows, candidate = active[near], candidate[near]
            d = x[rows] - self.c[candidate]
            d = (d * d).sum(axis=1)
            worked += len(rows)
            number = self.number[candidate]
            wins = (d < best[rows]) | ((d == best[rows]) & (number < who[rows]))
            best[rows[wins]], who[rows[wins]] = d[wins], number[wins]
        return who, best, worked


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole numbers) of up to ``BLOCK_ROWS`` rows and a batch more."""
    held, rows = [], 0

    def block():
        table = pa.Table.from_batches(held).combine_chunks()
        flat = b"".join(table.column("v").to_pylist())
        return table.column("id").combine_chunks(), np.frombuffer(flat, "<i4").reshape(-1, dims).astype(np.int64)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield block()
            held, rows = [], 0
    if held:
        yield block()


def cluster_sums(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, n, sums): rows and component sums of each centroid's nearest vectors, one row a centroid and task before they add up."""
    k, dims = centroids.shape
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))])

    def run(batches):
        search = Search(centroids)
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, x in _blocks(batches, dims):
            who, _, _ = search.nearest(x)
            count += np.bincount(who, minlength=k)
            np.add.at(sums, who, x)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
                                         ["cluster", "n", "sums"])

    parts = kept.mapInArrow(run, schema)
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums"))


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid with vectors becomes floor(sum / count) of them, exactly; the others stay."""
    after = centroids.copy()
    for row in cluster_sums(kept, centroids).collect():  # k rows
        after[row["cluster"]] = [total // row["n"] for total in row["sums"]]
    return after


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    dims = centroids.shape[1]
    schema = T.StructType([kept.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches):
        search = Search(centroids)
        for ids, x in _blocks(batches, dims):
            who, best, _ = search.nearest(x)
            yield pa.RecordBatch.from_arrays([ids, pa.array(who, pa.int32()), pa.array(best, pa.int64())], ["id", "cluster", "distance"])

    return kept.mapInArrow(run, schema)


def clustered(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS,
              scale: int = SCALE) -> DataFrame:
    """Cluster of each kept vector: key, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Left out are rows whose vector is null, has another length, or holds a null, NaN or infinity; other columns are not read. Rows
    that repeat count each time. A null key is assigned like any other but starts no centroid; with fewer than k keyed vectors there
    are fewer centroids, and without any the result is empty. Components beyond ``LARGEST / scale`` are an error, and so are more than 64 dimensions.
    """
    if not 1 <= dims <= 64:
        raise ValueError("1 to 64 dimensions")
    kept = written(kept_vectors(vectors, key, vector, dims, scale), "vectors")
    centroids = first_centroids(kept, dims, k)
    if not len(centroids):
        kept = kept.limit(0)
        centroids = np.zeros((1, dims), np.int64)
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    rows = written(assigned(kept, centroids), "clusters")
    each = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    totals = [(i, each[i], sum(each.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
              for i, c in enumerate(centroids) if i in each]
    small = rows.sparkSession.createDataFrame(totals, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(small), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
