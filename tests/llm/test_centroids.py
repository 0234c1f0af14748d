"""Centroid clustering against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from storelens.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance string, vector int"


def frame(spark, rows, repartition=3):
    """Vectors with columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, v, 1, 2, "d", 3) for i, v in rows], SCHEMA).repartition(repartition)


def whole(vector):
    return [math.floor(64 * float(np.float32(x))) for x in vector]


def brute(rows, k=16, rounds=3, size=64):
    kept = [(i, whole(v)) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), j) for j, p in enumerate(points))

    for _ in range(rounds):
        groups = [[] for _ in points]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        points = [[sum(c) // len(g) for c in zip(*g, strict=True)] if g else p for g, p in zip(groups, points, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = sum(d for _, d, _ in found)
    names = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, sum(e for _, e, f in found if f == c), inertia, names[c]) for i, d, c in found), key=str)


def vectors(seed, many, copies=0):
    rng = random.Random(seed)
    centers = [[rng.uniform(-0.5, 0.5) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(centers)]) for i in range(many)]
    return rows + [(many + i, rows[0][1]) for i in range(copies)]


CASES = {
    "spread": vectors(1, 150),
    "many copies": vectors(2, 60, copies=120),
    "few": vectors(3, 5),
    "one vector": [(i, [0.25] * 64) for i in range(40)],
    "odd rows": vectors(4, 30)
    + [(None, [0.1] * 64), (None, [0.2] * 64), (7, [0.1] * 64), (7, [0.1] * 64)]
    + [(100, None), (101, []), (102, [0.1] * 63), (103, [0.1] * 65), (104, [0.1] * 63 + [None])]
    + [(105, [0.1] * 63 + [math.nan]), (106, [0.1] * 63 + [math.inf]), (107, [-math.inf] * 64), (108, [20000.0] * 64)],
    "ties": [(i, [0.5 if j == i % 2 else 0.0 for j in range(64)]) for i in range(50)],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_brute_force(spark, name):
    got = centroids.with_inertia(*centroids.clustered(frame(spark, CASES[name])))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(CASES[name])


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, [0.5])]):
        assert centroids.with_inertia(*centroids.clustered(frame(spark, rows))).collect() == []


def test_too_large_a_component(spark):
    with pytest.raises(Exception, match="beyond"):
        centroids.clustered(frame(spark, [(1, [1e30] * 64)]))


def test_search_measures_few_and_loses_none():
    rng = np.random.default_rng(1)
    points = rng.integers(-30, 30, (200, 16)) + rng.integers(-90, 90, (200, 1))
    points[3] = points[2]
    asked = rng.integers(-30, 30, (2000, 16)) + rng.integers(-90, 90, (2000, 1))
    nearest, distance, measured = centroids.Centroids(points).nearest(asked)
    every = ((asked[:, None] - points[None]) ** 2).sum(axis=2)
    assert (nearest == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert measured < every.size / 4
