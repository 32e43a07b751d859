"""Centroid clustering in exact integers, pruned by Ptolemy's inequality.

Vectors become integers, floor(scale * x).  Lloyd's rounds assign every
vector to its nearest centroid (squared Euclidean distance, ties to the
smaller number) and move each non-empty centroid to the componentwise
floor(sum / count).

For points x, c and pivots p, q Ptolemy's inequality gives

    d(x, c) d(p, q)  >=  |d(x, p) d(c, q) - d(x, q) d(c, p)|.

The pivots are fixed (the first centroids), so d(x, p) is computed once and
kept beside each vector; a round computes only the k times m distances of
its centroids to the pivots.  A vector is first compared with the centroid
of the smallest bound; another is looked at only if its bound, rounded down
by more than the floating-point error, does not exceed the best distance so
far.  Survivors are compared exactly in 64-bit integers, so the bounds never
change the result, only the work.

The vectors are written to the shared folder once.  A round is one pass over
that table: a task sends k partial sums, Spark adds them, and the driver
sees k times d numbers.  Only the centroids (k vectors) are broadcast.

Cases: vectors that are null, of another length, or hold null or non-finite
components are left out; a component whose integer exceeds 2^27 in size ends
the job with an error (squared distances would not fit 64 bits); repeated
vectors and ids are rows of their own; of equal ids the smaller vector
starts first; a null id hashes as the empty string; fewer vectors than
centroids give as many centroids as vectors; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import map_arrow, stage

LARGEST = 1 << 27
SLACK = 1e-12            # relative; the bounds' own error is below 1e-14
BLOCK = 4096             # vectors that are compared at a time


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to one vector."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of the rows of ``x`` to the pivots, as doubles."""
    return np.sqrt(np.stack([squared(x, p) for p in pivots], axis=1).astype(np.float64)) if len(pivots) else np.zeros((len(x), 0))


def lower_bounds(xp: np.ndarray, cp: np.ndarray, pp: np.ndarray) -> np.ndarray:
    """Rows x centroids: the best Ptolemaic bound over all pivot pairs,
    rounded down.  ``xp``, ``cp``, ``pp``: distances to the pivots."""
    best = np.zeros((len(xp), len(cp)))
    for p in range(len(pp)):
        for q in range(p + 1, len(pp)):
            if pp[p, q] > 0:
                a, b = np.outer(xp[:, p], cp[:, q]), np.outer(xp[:, q], cp[:, p])
                np.maximum(best, (np.abs(a - b) - SLACK * (a + b)) / pp[p, q], out=best)
    return best * (1 - SLACK)


class Assigner:
    """Nearest centroids of blocks of vectors with cached pivot distances."""

    def __init__(self, centroids: list[list[int]], pivots: list[list[int]]):
        self.c, self.pivots = np.array(centroids, np.int64), np.array(pivots, np.int64)
        self.cp, self.pp = to_pivots(self.c, self.pivots), to_pivots(self.pivots, self.pivots)
        self.looked = self.pairs = 0

    def __call__(self, x: np.ndarray, xp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance)."""
        low = lower_bounds(xp, self.cp, self.pp)
        low *= low
        guess = low.argmin(axis=1)
        at, best = guess.copy(), squared(x, self.c[guess])
        self.looked, self.pairs = self.looked + len(x), self.pairs + low.size
        for k, c in enumerate(self.c):
            near = np.flatnonzero((low[:, k] <= best) & (guess != k))
            self.looked += len(near)
            d = squared(x[near], c)
            better = (d < best[near]) | ((d == best[near]) & (k < at[near]))
            at[near[better]], best[near[better]] = k, d[better]
        return at, best


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(id, v): the usable vectors as integers."""
    usable = (F.size(vector_col) == dim) & F.forall(
        vector_col, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    checked = F.transform(whole, lambda x: F.when(F.abs(x) <= LARGEST, x.cast("int")).otherwise(
        F.raise_error(F.lit(f"a component times {scale} exceeds {LARGEST}")).cast("int")))
    return table.select(F.col(id_col).alias("id"), F.col(vector_col).alias(vector_col)).where(usable.eqNullSafe(True)) \
                .select("id", checked.alias("v"))


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def cluster(table: DataFrame, k: int = 8, rounds: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64,
            scale: int = 1024, seed: int = 3) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every usable vector, and the centroids."""
    spark = table.sparkSession
    v = integer_vectors(table, id_col, vector_col, dim, scale)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    pivots = [list(r["v"]) for r in v.orderBy(rank, "v").limit(k).select("v").collect()]          # k rows
    id_type = v.schema["id"].dataType.simpleString()
    if not pivots:
        return spark.createDataFrame([], f"id {id_type}, cluster int, distance long"), []

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = np.array(pivots, np.int64)
        for b in batches:
            d = to_pivots(matrix(b.column(1), dim), p)
            yield pa.record_batch([b.column(0), b.column(1), pa.FixedSizeListArray.from_arrays(d.ravel(), len(p)).cast(pa.list_(pa.float64()))],
                                  names=["id", "v", "d"])

    cached = stage(map_arrow(v, measure, f"id {id_type}, v array<int>, d array<double>"), "pivot-distances")

    def blocks(b: pa.RecordBatch, vec: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        x, xp = matrix(b.column(vec), dim), b.column(vec + 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(pivots))
        for at in range(0, len(x), BLOCK):
            yield at, x[at:at + BLOCK], xp[at:at + BLOCK]

    centroids = pivots
    for _ in range(rounds):
        def partial(batches: Iterator[pa.RecordBatch], now=centroids) -> Iterator[pa.RecordBatch]:
            nearest, n, sums = Assigner(now, pivots), np.zeros(len(now), np.int64), np.zeros((len(now), dim), np.int64)
            for b in batches:
                for _, x, xp in blocks(b, 0):
                    to, _ = nearest(x, xp)
                    n += np.bincount(to, minlength=len(now))
                    np.add.at(sums, to, x)
            own = np.flatnonzero(n)
            yield pa.record_batch([pa.array(own, pa.int32()), pa.array(n[own]), pa.array(sums[own].tolist(), pa.list_(pa.int64()))],
                                  names=["cluster", "n", "sums"])

        parts = map_arrow(cached.select("v", "d"), partial, "cluster int, n long, sums array<long>")
        total = parts.select("cluster", "n", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at") \
                     .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")).collect()   # k times d rows
        moved = [list(c) for c in centroids]
        for r in total:
            moved[r["cluster"]][r["at"]] = int(r["x"]) // r["n"]
        if moved == centroids:
            break                                          # nothing can change any more
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Assigner(centroids, pivots)
        for b in batches:
            for at, x, xp in blocks(b, 1):
                to, d = nearest(x, xp)
                yield pa.record_batch([b.column(0).slice(at, len(x)), pa.array(to, pa.int32()), pa.array(d)], names=["id", "cluster", "distance"])

    return map_arrow(cached, assign, f"id {id_type}, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with the sums of distances and the centroids' digests."""
    assigned = stage(assigned, "clusters")
    spark = assigned.sparkSession
    sums = dict(assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())     # k rows
    rows = [(k, int(s), int(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for k, s in sums.items()]
    digests = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(digests), "cluster")      # k rows
