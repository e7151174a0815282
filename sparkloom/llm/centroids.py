"""Centroid clustering by partial-distance search over whole numbers.

Components become whole numbers, so distances and means are exact and do not
depend on how rows are dealt out.  An assignment adds squared differences up
over the dimensions that vary most first, and drops a centroid for a vector
once its sum is strictly above the best full distance so far; what is never
dropped finishes all dimensions, so ties are seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import discard, map_arrow, materialize

#: Whole components beyond this size are taken as this size: a squared distance over 64 of them fits a long.
LARGEST = 1 << 27

#: Dimensions that are added up between two looks at the best distance.
STEP = 8

#: Vectors searched together.
ROWS = 4096

_TOTALS = "cluster int, dim int, total bigint, n bigint"
_FOUND = "vec_id bigint, cluster int, distance bigint"


def whole(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component of the vectors that have ``dims`` components, none of them null or non-finite."""
    x = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int"))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where((F.size(vector) == dims) & usable).select(F.col(id).cast("bigint").alias("vec_id"), x.alias("v"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def assign(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance) of every row, ties to the smaller number.

    All centroids see the first dimensions of ``order``; each row then takes
    them by rising partial sum, and goes on with one, step by step, only while
    its sum is not above the row's best.
    """
    v, c = vectors[:, order], centroids[:, order]
    n, k = len(v), len(c)
    partial = np.stack([((v[:, :STEP] - c[j, :STEP]) ** 2).sum(1) for j in range(k)], axis=1)
    turns = np.argsort(partial, axis=1, kind="stable")
    best, cluster = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    for turn in turns.T:
        total = partial[np.arange(n), turn]
        rows = np.flatnonzero(total <= best)
        if not rows.size:
            break  # Partial sums only rise from turn to turn.
        total, mine = total[rows], turn[rows]
        for lo in range(STEP, v.shape[1], STEP):
            total = total + ((v[rows, lo : lo + STEP] - c[mine, lo : lo + STEP]) ** 2).sum(1)
            stays = total <= best[rows]
            rows, total, mine = rows[stays], total[stays], mine[stays]
        better = (total < best[rows]) | (mine < cluster[rows])
        best[rows[better]], cluster[rows[better]] = total[better], mine[better]
    return cluster, best


class _Search:
    """A pass that assigns whole vectors and gives either each one's cluster or the sums that the next centroids need."""

    def __init__(self, centroids: list[list[int]], order: list[int], sums: bool):
        self.centroids, self.order, self.sums = np.array(centroids, np.int64), np.array(order), sums

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = self.centroids.shape
        totals, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for whole_batch in batches:
            for lo in range(0, whole_batch.num_rows, ROWS):
                batch = whole_batch.slice(lo, ROWS)
                vectors = matrix(batch.column("v"), dims)
                cluster, distance = assign(vectors, self.centroids, self.order)
                if self.sums:
                    for j in np.unique(cluster):
                        totals[j] += vectors[cluster == j].sum(0)
                    counts += np.bincount(cluster, minlength=k)
                else:
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])
        if self.sums and counts.any():
            has = np.flatnonzero(counts)
            columns = [np.repeat(has, dims).astype(np.int32), np.tile(np.arange(dims, dtype=np.int32), has.size), totals[has].ravel(), np.repeat(counts[has], dims)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["cluster", "dim", "total", "n"])


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors whose ids have the smallest digests; rows that repeat an id by their components, rows without id never."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in vectors.where("vec_id IS NOT NULL").orderBy(by, "v").limit(k).collect()]


def by_variance(vectors: DataFrame, dims: int) -> list[int]:
    """The dimensions by falling variance; this order decides how soon a centroid is dropped, never what is found."""
    x = lambda d: F.col("v")[d].cast("double")
    row = vectors.agg(*[F.var_pop(x(d)).alias(f"d{d}") for d in range(dims)]).first()
    return sorted(range(dims), key=lambda d: (-(row[d] or 0.0), d))


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, id: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    ``rounds`` times all vectors go to their nearest centroid and each centroid
    that has some becomes the floor of their mean; then they are assigned once
    more.  Vectors that are null, of another length, or with a null or
    non-finite component are left out.  A row without id is clustered but is no
    first centroid; with fewer than ``k`` rows with an id there are fewer
    centroids, and without any no rows come out.  Rows that repeat an id are
    vectors of their own.  Components beyond 2**27 after scaling are taken as
    that; an inertia beyond a long is null.  Other columns are ignored.

    The driver holds ``k`` centroids and their sums, k * dims numbers a round;
    a task sends its sums, never its vectors.
    """
    spark = vectors.sparkSession
    rows = materialize(whole(vectors, id, vector, dims, scale), "vectors")
    centroids, order = first_centroids(rows, k, seed), by_variance(rows, dims)
    if not centroids:
        return spark.createDataFrame([], _FOUND + ", cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    for _ in range(rounds):
        sums = map_arrow(rows, _Search(centroids, order, True), _TOTALS).groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():
            centroids[r["cluster"]][r["dim"]] = r["total"] // r["n"]
    found = materialize(map_arrow(rows, _Search(centroids, order, False), _FOUND), "clusters")
    discard(rows)
    inertia = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    fits = lambda x: x if x < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    facts = [(i, fits(d), fits(sum(inertia.values())), digest(centroids[i])) for i, d in inertia.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
