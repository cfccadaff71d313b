"""Centroid clustering with n-simplex projection.

Exact integer k-means: components become floor(scale * x), centroids start as the vectors with
the smallest hashes, a round assigns every vector to its nearest centroid (ties: the smaller
number) and replaces centroids by the componentwise floor of their vectors' mean.

Filter: the distances of a vector to a few pivots fix an apex over the pivots' simplex: its
first coordinates are those of the vector's projection on the pivots' plane, the last is its height
over it. Of two apexes, the Euclidean distance is a lower bound of the vectors' distance,
and with one height turned down it is an upper bound. Pivots stay the same in all rounds, so
apexes are computed once and stored with the vectors; a round only needs those of the
centroids. A centroid whose lower bound is over the least upper bound is out, and
the rest are compared exactly, in 64-bit integers. Bounds are doubles and get a
slack above their rounding errors, so the result is exact.

Pivots are the starting centroids, without those that (nearly) lie in the others' plane.
A round sends k * (dim + 1) sums to the driver, whatever the table's size.

Defined cases: vectors that are null, of another dimension, or hold a null, non-finite or huge (scaled, 2**27
or more: squared distances wouldn't fit a long) component take no part; fewer vectors than k give fewer
centroids; repeated rows are clustered each; a null vec_id is clustered, and starts a centroid
only where others are lacking; equal hashes start by their components; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

K, DIM, SCALE, ROUNDS, SEED = 8, 64, 1024, 10, 3
HUGE = 2 ** 27
FLAT = 1e-6                     # a pivot must rise over the others' plane by this share (squared) of the largest distance
SLACK = 1e-5                    # share of the apexes' lengths; rounding stays far below
ROWS = 4096                     # vectors compared at once


class Simplex:
    """Pivots (rows of integers) and the plane through them."""

    def __init__(self, vectors: np.ndarray):
        x = (vectors - vectors[0]).astype(float)
        gram = x @ x.T                          # of the differences to the first pivot, which stays
        largest = max(float(gram.diagonal().max()), 1.0)
        taken, lower = [], np.zeros((0, 0))
        for i in range(1, len(vectors)):
            y = np.linalg.solve(lower, gram[taken, i]) if taken else np.zeros(0)
            height = gram[i, i] - y @ y
            if height > FLAT * largest:
                lower = np.block([[lower, np.zeros((len(taken), 1))], [y[None, :], np.sqrt([[height]])]])
                taken.append(i)
        self.pivots, self.lower, self.square = vectors[[0, *taken]], lower, gram[taken, taken]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances (rows x pivots)."""
        return np.stack([((x - p) ** 2).sum(axis=1) for p in self.pivots], 1)

    def apex(self, squared: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots: along the plane, then the height."""
        d = squared.astype(float)
        along = (d[:, :1] + self.square - d[:, 1:]) / 2
        along = np.linalg.solve(self.lower, along.T).T if len(self.lower) else along
        height = np.sqrt(np.maximum(d[:, 0] - (along ** 2).sum(axis=1), 0))
        return np.concatenate([along, height[:, None]], 1)


def candidates(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Whether a centroid may be the nearest (rows x centroids), by their apexes."""
    plane = ((apexes[:, None, :-1] - centroids[None, :, :-1]) ** 2).sum(axis=2)
    a, c = apexes[:, -1:], centroids[:, -1]
    lower, upper = np.sqrt(plane + (a - c) ** 2), np.sqrt(plane + (a + c) ** 2)
    slack = SLACK * (1 + np.sqrt((apexes ** 2).sum(axis=1)) + np.sqrt((centroids ** 2).sum(axis=1)).max())
    return lower <= (upper.min(axis=1) + slack)[:, None]


def nearest(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid, and how many distances that took."""
    number, squared, n = np.empty(len(x), np.int64), np.empty(len(x), np.int64), 0
    for lo in range(0, len(x), ROWS):
        part = x[lo:lo + ROWS]
        row, c = np.nonzero(candidates(apexes[lo:lo + ROWS], centroid_apexes))
        exact = np.full((len(part), len(centroids)), np.iinfo(np.int64).max)
        exact[row, c] = ((part[row] - centroids[c]) ** 2).sum(axis=1)
        best = exact.argmin(axis=1)             # the first of equal ones
        number[lo:lo + ROWS], squared[lo:lo + ROWS] = best, exact[np.arange(len(part)), best]
        n += len(row)
    return number, squared, n


def quantised(rows: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id, q (integer components) of the rows that take part."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < HUGE))
    q = F.transform(e, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    return rows.where(e.isNotNull() & (F.size(e) == dim) & F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(kind)


def _start(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(order.asc_nulls_last(), "q").limit(k)
    return np.array([r["q"] for r in first.collect()], np.int64)


def cluster(rows: DataFrame, k: int = K, dim: int = DIM, scale: int = SCALE, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance (squared) per vector that takes part, the final centroids by number)."""
    vectors = quantised(rows, dim, scale)
    centroids = _start(vectors, k, seed)
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    simplex = Simplex(centroids)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            apex = simplex.apex(simplex.distances(_matrix(b.column(1), np.int64))) if b.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.FixedSizeListArray.from_arrays(pa.array(apex.ravel()), apex.shape[1]).cast(pa.list_(pa.float64()))],
                ["vec_id", "q", "apex"])

    cached = written(vectors.mapInArrow(projected, "vec_id long, q array<int>, apex array<double>"), "simplex-apexes")

    def sums(centroids: np.ndarray):
        apexes = simplex.apex(simplex.distances(centroids))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(centroids), dim + 1), np.int64)
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column(0), np.int64)
                    number, _, _ = nearest(x, _matrix(b.column(1), float), centroids, apexes)
                    for c in np.unique(number):
                        mine = x[number == c]
                        total[c, :dim] += mine.sum(axis=0)
                        total[c, dim] += len(mine)
            c, d = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(total[c, d])], ["c", "d", "s"])

        return run

    for _ in range(rounds):
        got = cached.select("q", "apex").mapInArrow(sums(centroids), "c int, d int, s long").groupBy("c", "d").agg(F.sum("s").alias("s"))
        total = np.zeros((len(centroids), dim + 1), np.int64)
        for c, d, s in got.collect():
            total[c, d] = s
        new = np.where(total[:, dim:] > 0, total[:, :dim] // np.maximum(total[:, dim:], 1), centroids)
        if (new == centroids).all():            # further rounds change nothing
            break
        centroids = new
    apexes = simplex.apex(simplex.distances(centroids))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                number, squared, _ = nearest(_matrix(b.column(1), np.int64), _matrix(b.column(2), float), centroids, apexes)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(number.astype(np.int32)), pa.array(squared)], ["vec_id", "cluster", "distance"])

    return cached.mapInArrow(assigned, "vec_id long, cluster int, distance long"), centroids


def report(rows: DataFrame, **how) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per vector that takes part."""
    found, centroids = cluster(rows, **how)
    found = written(found, "simplex-clusters")
    per = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def of(values: list, kind: str):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.lit(None).cast(f"array<{kind}>"), F.col("cluster"))

    return found.select("vec_id", "cluster", "distance", of([per.get(c, 0) for c in range(len(sha))], "long").alias("cluster_inertia"),
                        F.lit(sum(per.values())).cast("long").alias("inertia"), of(sha, "string").alias("centroid_sha256"))
