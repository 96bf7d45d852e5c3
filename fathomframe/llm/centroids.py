"""Clustering by centroids: the nearest one is the winner of a tournament over bisecting planes, in integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Components are held within this bound, so that squared distances and sign tests fit 64 bits.
BOUND = 1 << 27
#: Sums of products below this are exact in double precision, where matrix products are fast.
_EXACT = 1 << 53


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
              dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, v: the vectors with the right number of components, none null or infinite, as integers floor(scale * x)."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    fine = (F.size(x) == dimensions) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = F.transform(x, lambda c: F.floor(F.greatest(F.lit(-1.0 * BOUND), F.least(F.lit(1.0 * BOUND), c * scale))).cast("int"))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(vec_id).alias("vec_id"), held.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest digests of seed and id, in that order; clusters rows or as many as there are."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(digest.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


@dataclass
class Bisectors:
    """For each pair a < b of centroids the integer normal and threshold of the plane between them.

    x is strictly nearer to b than to a if normals[a, b] . x > thresholds[a, b].
    """

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Bisectors:
        square = (centroids * centroids).sum(axis=1)
        return cls(centroids, 2 * (centroids[None] - centroids[:, None]), square[None] - square[:, None])

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of each row's nearest centroid: k - 1 sign tests a row, the smaller number winning at zero."""
        won = np.zeros(len(x), np.int64)
        small = x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(self.normals).max(initial=0)) < _EXACT
        kind = np.float64 if small else np.int64
        rows, normals = x.astype(kind), self.normals.astype(kind)
        for b in range(1, len(self.centroids)):
            for a in np.unique(won):
                mine = np.flatnonzero(won == a)
                nearer = rows[mine] @ normals[a, b] > self.thresholds[a, b]
                won[mine[nearer]] = b
        return won

    def distances(self, x: np.ndarray, won: np.ndarray) -> np.ndarray:
        gap = x - self.centroids[won]
        return np.einsum("ij,ij->i", gap, gap)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, dimensions)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each non-empty centroid becomes the floor of its vectors' mean, in exact numbers.

    A batch gives one row of sums for each centroid it meets, so at most that many narrow rows are shuffled and the
    driver receives one row for each centroid, however many vectors there are.
    """
    planes, dimensions = Bisectors.of(centroids), centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dimensions)
            won = planes.winners(x)
            met = np.unique(won)
            total = [x[won == c].sum(axis=0) for c in met]
            yield pa.RecordBatch.from_arrays(
                [pa.array(met), pa.array([int((won == c).sum()) for c in met]), pa.array([t.tolist() for t in total], pa.list_(pa.int64()))],
                ["cluster", "n", "total"])

    partial = vectors.select("v").mapInArrow(sums, "cluster long, n long, total array<long>")
    whole = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimensions)]
    out = centroids.copy()
    for r in partial.groupBy("cluster").agg(F.sum("n").alias("n"), *whole).collect():
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dimensions)]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance: each vector with its nearest centroid and the squared distance to it."""
    planes, dimensions = Bisectors.of(centroids), centroids.shape[1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dimensions)
            won = planes.winners(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(won.astype(np.int32)), pa.array(planes.distances(x, won))], ["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(place, f"vec_id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
            seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of each vector, written, and the final centroids.

    Vectors are kept in integers in one written table, which each round reads once without a shuffle of vectors.
    A vector that is null, of another length or with a null or infinite component is left out. Integers beyond
    2**27 either way are held at that bound, since no distance beyond would fit 64 bits. Vectors with one id are
    vectors of their own; where ids tie, the smaller vector comes first as a first centroid; a null id counts as
    an empty one. With fewer vectors than clusters each starts a centroid; without vectors the result is empty.
    """
    whole = written(quantised(vectors, vec_id, vector, dimensions, scale), "vectors")
    centroids = first_centroids(whole, clusters, seed)
    if not len(centroids):
        return whole.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        after = moved(whole, centroids)
        if np.array_equal(after, centroids):  # nothing moves any more, nor will it in later rounds
            break
        centroids = after
    return written(assigned(whole, centroids), "clustered"), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(placed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """placed with cluster_inertia, inertia and centroid_sha256; what the driver holds has a row for each centroid.

    A sum of distances beyond 64 bits is null.
    """
    found = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    own = {r["cluster"]: int(r["s"]) for r in found}

    def number(x: int) -> Column:
        return F.lit(x if x < 1 << 63 else None).cast("long")

    def by_cluster(values: dict[int, Column], kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for c, v in values.items():
            out = F.when(F.col("cluster") == c, v).otherwise(out)
        return out

    return placed.withColumns({
        "cluster_inertia": by_cluster({c: number(s) for c, s in own.items()}, "long"),
        "inertia": number(sum(own.values())),
        "centroid_sha256": by_cluster({c: F.lit(digest(centroids[c])) for c in own}, "string")})
