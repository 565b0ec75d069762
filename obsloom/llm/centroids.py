"""Clustering around centroids in whole numbers, the nearest one found by Orchard's search.

Vectors become integers, ``floor(scale * x)``, so that distances and means are exact and the same on
every machine. A round sends the centroids (``k`` vectors, nothing else) to the tasks, which give back
per cluster the number of its vectors and their sums; only these sums are shuffled.

Orchard's search keeps, for every centroid, all centroids sorted by their distance from it. A vector
goes through the list of the closest centroid found so far; whenever one is closer, the search jumps
to that one's list. Centroids already measured are marked and not measured again. In a list sorted by
distance, all that follow one at more than twice the current distance are farther from the vector than
the current centroid, strictly, so that ties are still seen; the smaller number wins them.

Defined results: a null vector, one of another length, or one with null or non-finite components gives
no row. With fewer vectors than ``k`` there are as many centroids as vectors. A row without an id is
clustered, but never a first centroid; rows that repeat an id are vectors of their own. A component beyond
+-2^27 (less above 128 components) counts as that bound, so that every distance fits a long; sums beyond a
long give its maximum.
Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsloom.llm.common import mapped, stored

LONG_MAX = (1 << 63) - 1
#: Vectors that go through their lists together.
STEP = 8192


class Orchard:
    """The centroids with their sorted lists."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        k = len(centroids)
        apart = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids]) if k else np.zeros((0, 0), np.int64)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        self.lengths = np.sqrt((centroids.astype(np.float64) ** 2).sum(axis=1))
        self.by_length = np.argsort(self.lengths, kind="stable")

    def start(self, vectors: np.ndarray) -> np.ndarray:
        """A centroid of about each vector's length: any start is right, a near one is quick."""
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        at = np.searchsorted(self.lengths[self.by_length], lengths)
        return self.by_length[np.minimum(at, len(self.by_length) - 1)]

    def distance(self, vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        return ((vectors - self.centroids[centroid]) ** 2).sum(axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid."""
        k, n = len(self.centroids), len(vectors)
        best = self.start(vectors)
        least = self.distance(vectors, best)
        seen = np.zeros((n, k), bool)
        seen[np.arange(n), best] = True
        place = np.zeros(n, np.int64)
        active = np.arange(n)
        while len(active):
            # A list ends, or has only centroids that are farther from the vector than the current one.
            now, at = best[active], place[active]
            going = at < k
            apart = np.take(self.apart, now * k + np.minimum(at, k - 1))
            # apart > 4 * least, without the product: it may not fit.
            going &= ~((apart - 1) // 4 >= least[active])
            active, now, at = active[going], now[going], at[going]
            candidate = np.take(self.order, now * k + at)
            place[active] += 1
            fresh = ~seen[active, candidate]
            some, candidate = active[fresh], candidate[fresh]
            seen[some, candidate] = True
            d = self.distance(vectors[some], candidate)
            closer = (d < least[some]) | ((d == least[some]) & (candidate < best[some]))
            some, candidate = some[closer], candidate[closer]
            best[some], least[some], place[some] = candidate, d[closer], 0
        return best, least


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, size: int, scale: int) -> DataFrame:
    """Columns ``id`` and ``v``: the usable vectors as whole numbers."""
    v = F.col(embedding).cast("array<double>")
    usable = (F.size(v) == size) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = float(min(1 << 27, math.isqrt(LONG_MAX // max(size, 1)) // 2))
    bounded = lambda x: F.greatest(F.lit(-largest), F.least(F.lit(largest), x * scale))
    return vectors.where(usable).select(F.col(vec_id).alias("id"), F.transform(v, lambda x: F.floor(bounded(x)).cast("int")).alias("v"))


def matrix(column, size: int) -> np.ndarray:
    """A list column of ``size`` numbers each as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def assigned(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Columns ``id``, ``cluster`` and ``distance`` of every point."""

    def run(batches):
        import pyarrow as pa

        orchard = Orchard(centroids)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                piece = batch.slice(at, STEP)
                best, least = orchard.nearest(matrix(piece.column("v"), centroids.shape[1]))
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(best.astype(np.int32)), pa.array(least)], names=["id", "cluster", "distance"])

    kind = points.schema["id"].dataType.simpleString()
    return mapped(points, run, f"id {kind}, cluster int, distance long")


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floored mean of each one's vectors, itself if it has none."""
    k, size = centroids.shape

    def run(batches):
        import pyarrow as pa

        orchard = Orchard(centroids)
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                vectors = matrix(batch.slice(at, STEP).column("v"), size)
                best, _ = orchard.nearest(vectors)
                np.add.at(sums, best, vectors)
                counts += np.bincount(best, minlength=k)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    parts = mapped(points.select("v"), run, "cluster int, n long, sums array<long>")
    at = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    # A row for every component of every centroid, whatever the number of vectors.
    means = at.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for r in means.collect():
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    size: int = 64,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    seed: int = 1,
) -> DataFrame:
    """One row per usable vector: ``vec_id``, ``cluster``, its squared ``distance`` from the centroid, and ``centroid``.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``<seed>:<vec_id>``. ``k`` times
    ``size`` numbers are held by the driver and every task.
    """
    spark = vectors.sparkSession
    points = stored(whole_vectors(vectors, vec_id, embedding, size, scale))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = points.where("id is not null").select(drawn.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, size)
    found = f"{vec_id} {points.schema['id'].dataType.simpleString()}, cluster int, distance long, centroid array<long>"
    if not len(centroids):
        return spark.createDataFrame([], found)
    for _ in range(rounds):
        centroids = moved(points, centroids)
    final = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "cluster int, centroid array<long>")
    rows = stored(assigned(points, centroids)).withColumnRenamed("id", vec_id)
    return rows.join(F.broadcast(final), "cluster").select(vec_id, "cluster", "distance", "centroid")


def with_inertia(rows: DataFrame) -> DataFrame:
    """The rows of ``cluster`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``, from a row per cluster."""
    fits = lambda total: F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    per = rows.groupBy(F.col("cluster").alias("__c")).agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("part"), F.first("centroid").alias("middle"))
    per = per.withColumn("whole", F.sum("part").over(Window.partitionBy(F.lit(0)))).select(
        "__c",
        fits(F.col("part")).alias("cluster_inertia"),
        fits(F.col("whole")).alias("inertia"),
        F.sha2(F.array_join(F.col("middle").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )
    return rows.join(F.broadcast(per), F.col("cluster") == F.col("__c")).drop("__c")
