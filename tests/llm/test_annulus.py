import hashlib
import math
import random

import numpy as np
import pytest

from corvane.llm import annulus as A


def plain(rows, k, rounds, dims, scale=256):
    """Whole numbers of Python, all centroids compared with all vectors."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            scaled = [math.floor(scale * x) for x in v]
            if all(-A.MOST_COMPONENT <= x < A.MOST_COMPONENT for x in scaled):
                kept.append((vec_id, scaled))
    rank = lambda x: (x[0] is None, hashlib.sha256(f"2:{x[0]}".encode()).hexdigest() if x[0] is not None else "", x[1])
    centroids = [v for _, v in sorted(kept, key=rank)[:k]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        for i, vs in groups.items():
            centroids[i] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    placed = [(vec_id, *best(v)) for vec_id, v in kept]
    inertia = {i: sum(d for _, d, j in placed if j == i) for i in range(len(centroids))}
    shown = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((vec_id, i, d, inertia[i], sum(inertia.values()), shown[i]) for vec_id, d, i in placed), key=repr)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("spread", [3, 100, 1 << 26])
def test_nearest_against_all(spread):
    r = np.random.default_rng(spread)
    x, c = r.integers(-spread, spread, (700, 8)), r.integers(-spread, spread, (30, 8))
    c[7], c[9], x[:30] = c[3], -c[3], c  # equal and opposite centroids, vectors on them
    x[30] = 0
    every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    cluster, distance = A.nearest(x, c)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_boundary_ties():
    c = np.array([[5, 0], [0, 5], [-5, 0], [3, 4], [0, 0]])
    x = np.array([[0, 0], [5, 5], [-5, 5], [0, -3], [5, 0]])
    every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    cluster, distance = A.nearest(x, c)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_clusters_against_brute_force(spark):
    r = random.Random(5)
    centres = [[r.uniform(-1, 1) for _ in range(6)] for _ in range(9)]
    rows = [(i, [x + r.gauss(0, 0.2) for x in r.choice(centres)]) for i in range(300)]
    rows += [(300, None), (301, [1.0]), (302, [None] * 6), (303, [math.nan] * 6), (304, [math.inf, 0, 0, 0, 0, 0]), (305, [0.0] * 6), (305, [0.0] * 6), (None, [0.5] * 6)]
    rows += [(306, [1e30, 0, 0, 0, 0, 0]), (307, [-524288.0, 0, 0, 0, 0, 0]), (308, [524288.0, 0, 0, 0, 0, 0]), (-1, [-1e-9] * 6), (0, [0.25] * 6)]
    rows = [(i, v and [None if x is None else float(x) for x in v]) for i, v in rows]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    for k, rounds in ((10, 5), (3, 0), (1000, 2)):
        assert collected(A.centroid_clusters(vectors, k, rounds, dims=6)) == plain(rows, k, rounds, 6)


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, cluster int, v string, distance long"
    assert A.centroid_clusters(spark.createDataFrame([], schema), dims=2).collect() == []
    assert A.centroid_clusters(spark.createDataFrame([(1, None, 1, "", 2), (2, [1.0], 1, "", 2)], schema), dims=2).collect() == []
    rows = [(1, [1.0, 2.0], 9, "x", 9), (1, [1.0, 2.0], 9, "x", 9)]
    got = A.centroid_clusters(spark.createDataFrame(rows, schema), dims=2).collect()
    assert [tuple(r)[:5] for r in got] == [(1, 0, 0, 0, 0)] * 2
    with pytest.raises(ValueError):
        A.centroid_clusters(spark.createDataFrame(rows, schema), dims=65)
