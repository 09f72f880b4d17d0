"""Clusters around centroids in whole numbers, with an annulus search for the nearest centroid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import ship
from corvane.shared import written

#: Scaled components stay under it, so that a squared distance over up to 64 of them fits a long and its norm's error is known.
MOST_COMPONENT = 1 << 27
#: Numbers of one block of candidate distances.
BLOCK = 1 << 22
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of the nearest centroid of each row, the smaller number of several; whole numbers, exact.

    Centroids are sorted by norm. The distance to the two whose norms are next to a vector's is its upper bound; no centroid whose
    norm differs from the vector's by more can be as near, by the triangle inequality. The others, an annulus around the origin,
    are a range of the sorted ones found by binary search, and are compared exactly. The range is widened by more than the error
    of the square roots, so that centroids at the bound itself are in it.
    """
    squares = (centroids * centroids).sum(axis=1)
    order = np.argsort(squares, kind="stable")
    norms, k = np.sqrt(squares[order].astype(np.float64)), len(order)
    own = np.sqrt((x * x).sum(axis=1).astype(np.float64))

    def apart(rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        d = x[rows] - centroids[which]
        return (d * d).sum(axis=1)

    cluster, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    everything, above = np.arange(len(x)), np.searchsorted(norms, own)
    bound = np.full(len(x), np.iinfo(np.int64).max)
    step = max(1, BLOCK // max(1, x.shape[1]))
    for i in range(0, len(x), step):
        rows = everything[i : i + step]
        for at in (np.minimum(above[rows], k - 1), np.maximum(above[rows] - 1, 0)):
            bound[rows] = np.minimum(bound[rows], apart(rows, order[at]))
    reach = np.sqrt(bound.astype(np.float64))
    slack = 1e-9 * (1.0 + reach + own)
    low = np.searchsorted(norms, own - reach - slack, "left")
    high = np.searchsorted(norms, own + reach + slack, "right")
    total = np.cumsum(high - low)
    i = 0
    while i < len(x):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + step, "right")))
        n = (high - low)[i:j]
        starts = np.cumsum(n) - n
        rows = np.repeat(everything[i:j], n)
        which = order[np.arange(len(rows)) - np.repeat(starts, n) + np.repeat(low[i:j], n)]
        d = apart(rows, which)
        distance[i:j] = np.minimum.reduceat(d, starts)
        cluster[i:j] = np.minimum.reduceat(np.where(d == np.repeat(distance[i:j], n), which, k), starts)
        i = j
    return cluster, distance


def scaled_vectors(vectors: DataFrame, dims: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors with dims components, none null or not finite, as floor(scale * x)."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fits = F.forall(v, lambda x: F.coalesce((x * scale < MOST_COMPONENT) & (x * scale >= -MOST_COMPONENT), F.lit(False)))
    rows = rows.filter(F.when(F.size(v) == dims, fits).otherwise(False))  # a NaN is larger than any number
    return rows.select("vec_id", F.transform(v, lambda x: F.floor(x * scale).cast("int")).alias("v"))


def _numbers(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round. Each task sends one sum a component and cluster, the driver gets as many rows in all."""
    k, dims = centroids.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            x = _numbers(batch, dims)
            cluster, _ = nearest(x, centroids)
            by = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[by], return_index=True)
            if len(present):
                sums[present] += np.add.reduceat(np.c_[x, np.ones(len(x), np.int64)][by], first, axis=0)
        here = np.flatnonzero(sums[:, dims])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(here, dims + 1), pa.int32()), pa.array(np.tile(np.arange(dims + 1), len(here)), pa.int32()), pa.array(sums[here].ravel(), pa.int64())],
            names=["cluster", "place", "sum"],
        )

    parts = kept.select("v").mapInArrow(summed, "cluster int, place int, sum long")
    total = parts.groupBy("cluster", "place").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    at = {(r.cluster, r.place): int(r["sum"]) for r in total.collect()}
    out = centroids.copy()
    for c in {c for c, _ in at}:
        out[c] = [at[c, i] // at[c, dims] for i in range(dims)]  # whole numbers of any size, rounded down
    return out


def centroid_clusters(
    vectors: DataFrame, k: int = 40, rounds: int = 5, salt: str = "2", dims: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    The first centroids are the k kept vectors with the smallest SHA-256 of "<salt>:<vec_id>"; each round assigns every vector to
    the nearest and replaces every centroid that has vectors by the floor of their mean. All numbers are whole, so results don't
    depend on how rows are dealt out. Centroids, their sums and inertias are all that reaches the driver: k rows of dims numbers.

    Vectors that are null, have another number of components, or hold null, not finite or huge ones (scaled, 2^27 or more) are left
    out. Equal hashes go by the vector, null identifiers come last; with fewer than k vectors, each is a centroid. Repeated rows count
    each. Sums of distances that no long holds are null. Other columns aren't read, whatever their names. An empty table gives no rows.
    """
    if dims > 64:
        raise ValueError("squared distances over more than 64 components may not fit a long")
    spark = vectors.sparkSession
    ship(spark)
    kept = written(scaled_vectors(vectors, dims, scale, id_col, vector_col), "scaled")
    ranked = kept.select(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).alias("h"), "v")
    first = ranked.orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids = np.array([r.v for r in first], np.int64)
    for _ in range(rounds):
        centroids = _moved(kept, centroids)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = nearest(_numbers(batch, dims), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    rows = written(kept.mapInArrow(assigned, "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    facts = spark.createDataFrame(
        [(c, fits(s), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
