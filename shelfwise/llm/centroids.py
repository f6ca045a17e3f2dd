"""Centroid clustering by a bisector tournament, exact in integers.

Vectors become integers (``floor(scale * x)``). For every pair of centroids i < j the
normal ``2 * (c_j - c_i)`` and the threshold ``|c_j|^2 - |c_i|^2`` are computed once a round:
``x . normal - threshold`` is positive exactly where c_j is strictly nearer. A vector starts with centroid 0
as its winner and meets the others in ascending order, k - 1 sign tests in all; zero favours the smaller
number. Only the last winner's distance is computed, exactly.

Every task adds up its vectors by cluster, Spark adds the tasks' sums, and the driver sees
k rows of ``dims`` sums a round; no group of vectors meets in one task, so one vector that a third
of the rows repeat, or one cluster with all rows, costs no more than any other.

Nulls and edges: vectors that are null, or have another number of components, or a null, NaN or infinite
one, are left out; components beyond ``limit(dims)`` (2**27 for 64) count as that, so that every
product and distance fits 64 bits; a null id is hashed as the empty text; repeated rows count one by one;
equal hashes go by vector; with fewer vectors than k there are as many centroids; an empty table gives
an empty result; an inertia beyond 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import map_arrow, materialise

#: The table of normals has k * k * dims numbers, on the driver and in each worker.
MAX_CENTROIDS = 256
_LONG = 2**63 - 1


def limit(dims: int) -> int:
    """Largest component for which 4 * dims * limit**2 stays within 2**62."""
    return isqrt(2**60 // dims)


@dataclass(frozen=True)
class Bisectors:
    """Centroids with, for each pair (i, j), the normal and threshold of the plane between them."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: list[list[int]]) -> Bisectors:
        c = np.array(centroids, dtype=np.int64)
        squares = (c * c).sum(axis=1)
        return cls(c, 2 * (c[None, :, :] - c[:, None, :]), squares[None, :] - squares[:, None])

    def winners(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of every row; the smaller number where two are as near."""
        won = np.zeros(len(x), dtype=np.int64)
        for j in range(1, len(self.centroids)):
            side = np.einsum("nd,nd->n", x, self.normals[won, j]) - self.thresholds[won, j]
            won[side > 0] = j
        return won

    def distances(self, x: np.ndarray, won: np.ndarray) -> np.ndarray:
        """Squared distance of every row to its winner."""
        gap = x - self.centroids[won]
        return np.einsum("nd,nd->n", gap, gap)


def integer_vectors(vectors: DataFrame, dims: int, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """Kept vectors: vec_id, v (array of integers)."""
    x = F.col(embedding).cast("array<double>")
    infinite = F.lit(float("inf"))
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < infinite), F.lit(False)))
    most = limit(dims) / scale
    cut = lambda e: F.greatest(F.least(e, F.lit(most)), F.lit(-most))
    return vectors.where(F.coalesce((F.size(x) == dims) & finite, F.lit(False))).select(
        F.col(vec_id).alias("vec_id"), F.transform(x, lambda e: F.floor(cut(e) * scale).cast("int")).alias("v")
    )


def first_centroids(kept: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors (a bound on what the driver reads) with the smallest digest of ``seed``:id, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k)
    return first.toArrow()["v"].to_pylist()


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _sums(kept: DataFrame, planes: Bisectors) -> dict[tuple[int, int], tuple[int, int]]:
    """By (cluster, place): sum of the components and number of vectors; k * dims rows."""
    k, dims = planes.centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            won = planes.winners(x)
            counts += np.bincount(won, minlength=k)
            np.add.at(totals, won, x)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(counts[seen]), pa.array(totals[seen].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"],
        )

    parts = map_arrow(kept.select("v"), work, "cluster int, n long, total array<long>")
    summed = (
        parts.select("cluster", "n", F.posexplode("total").alias("place", "x"))
        .groupBy("cluster", "place")
        .agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    )
    return {(r["cluster"], r["place"]): (r["x"], r["n"]) for r in summed.toArrow().to_pylist()}


def moved(planes: Bisectors, sums: dict[tuple[int, int], tuple[int, int]]) -> list[list[int]]:
    """Exact floors of the means; a centroid without vectors stays."""
    out = planes.centroids.tolist()
    for (cluster, place), (x, n) in sums.items():
        out[cluster][place] = x // n
    return out


def _assign(kept: DataFrame, planes: Bisectors) -> DataFrame:
    dims = planes.centroids.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            won = planes.winners(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(won.astype(np.int32)), pa.array(planes.distances(x, won))],
                names=["vec_id", "cluster", "distance"],
            )

    kind = dict(kept.dtypes)["vec_id"]
    return map_arrow(kept.select("vec_id", "v"), work, f"vec_id {kind}, cluster int, distance long")


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: str = "3",
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Rounds end early once no centroid moves, as all further ones would change nothing.
    """
    if not 1 <= k <= MAX_CENTROIDS:
        raise ValueError(f"k must be 1 to {MAX_CENTROIDS}")
    spark = vectors.sparkSession
    kept = materialise(integer_vectors(vectors, dims, scale, vec_id, embedding), "centroid-vectors")
    centroids = first_centroids(kept, k, seed)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        none = spark.createDataFrame([], schema)
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).join(none, "cluster").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    for _ in range(rounds):
        planes = Bisectors.of(centroids)
        after = moved(planes, _sums(kept, planes))
        if after == centroids:
            break
        centroids = after
    assigned = materialise(_assign(kept, Bisectors.of(centroids)), "centroid-clusters")
    summed = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).toArrow().to_pylist()
    by_cluster = {r["cluster"]: int(r["d"]) for r in summed}
    fits = lambda x: x if x <= _LONG else None
    rows = [
        (c, fits(d), fits(sum(by_cluster.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, d in sorted(by_cluster.items())
    ]
    # k rows at most
    return assigned.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
