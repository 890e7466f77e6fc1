"""Rotated k-means against plain integer clustering; odd vectors, equal distances, filters that leave out work."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from paymart.llm import rotated_kmeans as rk

SCHEMA = "cluster long, x string, vec_id long, embedding array<float>, p string, label int"


def brute(rows, k=8, rounds=10, n=64):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == n and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in e]))
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    centroids = [x for _, x in order[:k]]

    def assign(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(assign(x)[1], []).append(x)
        for j, g in groups.items():
            centroids[j] = [sum(col) // len(g) for col in zip(*g)]
    got = [(i, *assign(x)) for i, x in kept]
    per = Counter()
    for _, d, c in got:
        per[c] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, per[c], sum(per.values()), names[c]) for i, d, c in got]


def frame(spark, rows):
    return spark.createDataFrame([(1, "x", i, e, "p", 0) for i, e in rows], SCHEMA).repartition(3)


def vectors(n, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (6, 64))
    return [[float(x) for x in np.float32(centers[rng.integers(6)] + rng.normal(0, spread, 64))] for _ in range(n)]


def check(spark, rows):
    got = Counter(tuple(r) for r in rk.op11_rotated_kmeans(frame(spark, rows)).collect())
    assert got == Counter(brute(rows))


def test_against_brute_force_with_odd_rows(spark):
    rows = list(enumerate(vectors(150, 1)))
    odd = vectors(4, 2)
    rows += [(200, None), (201, []), (202, odd[0][:63]), (203, odd[0] + [1.0]), (204, [None] + odd[0][1:]), (205, [float("nan")] + odd[0][1:])]
    rows += [(206, [float("-inf")] + odd[0][1:]), (None, odd[1]), (3, odd[2]), (7, odd[3])] + [(300, odd[3])] * 40
    check(spark, rows)


def test_equal_distances_take_the_smaller_number(spark):
    zero = [0.0] * 64
    rows = [(i, [float(i % 4 == j) for j in range(4)] + zero[4:]) for i in range(40)] + [(100 + i, zero) for i in range(9)]
    check(spark, rows)


def test_fewer_rows_than_centroids_and_none(spark):
    check(spark, [(5, vectors(1, 3)[0])])
    check(spark, [(i, [0.5] * 64) for i in range(3)])
    none = rk.op11_rotated_kmeans(frame(spark, []))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_large_components_say_so(spark):
    with pytest.raises(Exception, match="not under"):
        rk.op11_rotated_kmeans(frame(spark, [(1, [1e9] * 64)]))


def test_bound_filters_and_never_misses():
    rng = np.random.default_rng(5)
    centers = rng.integers(-900, 900, (8, 64))
    x = centers[rng.integers(8, size=4000)] + rng.integers(-150, 150, (4000, 64))
    rotation = rk.Rotation(x.mean(0), np.cov(x.T), 16)
    cluster, distance, measured = rk.nearest(x, rotation(x), centers, rotation(centers))
    exact = ((x[:, None, :] - centers[None]) ** 2).sum(2)
    assert (distance == exact.min(1)).all() and (cluster == exact.argmin(1)).all()
    assert measured < 1.2 * len(x)  # of 8 * len(x)
