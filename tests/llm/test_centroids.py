"""Centroid clustering against all distances."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA)


def brute(vectors, width, clusters, rounds):
    top = (1 << 63) - 1
    rows = []
    for i, v in vectors:
        if v is None or len(v) != width or any(x is None or not np.isfinite(np.float32(x)) for x in v):
            continue
        whole = [int(np.floor(float(np.float32(x)) * 1024)) for x in v]
        rows.append((i, [max(-top - 1, min(top, x)) for x in whole]))
    first = sorted(
        rows, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[0] or 0, r[1])
    )
    held = [list(v) for _, v in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(held))

    for _ in range(rounds):
        groups = {}
        for _, v in rows:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            held[n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in rows]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + min(d, top)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in held]
    total = sum(inertia.values())
    return sorted(
        ((i, c, min(d, top), min(inertia[c], top), min(total, top), digest[c]) for i, c, d in found), key=str
    )


def found(df, **options):
    return sorted((tuple(r) for r in centroids.told(*centroids.cluster(df, **options)).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_vectors_with_ties(spark, seed):
    rng = random.Random(seed)
    values = [-1.0, -0.5, 0.0, 0.25, 1.0] if seed else [0.0, 1.0]
    vectors = [(i, [rng.choice(values) + seed * rng.random() for _ in range(4)]) for i in range(200)]
    assert found(table(spark, vectors), clusters=5, rounds=4, width=4) == brute(vectors, 4, 5, 4)


def test_production_parameters(spark):
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 0.2, (12, 64))
    vectors = [(i, (middle[i % 12] + rng.normal(0, 0.1, 64)).tolist()) for i in range(300)]
    assert found(table(spark, vectors)) == brute(vectors, 64, 8, 10)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.0, 9.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]),
        (4, [inf, 0.0]), (5, [1.0]), (6, []), (None, [-3.0, 0.1]), (8, [-3.0, 0.1]), (9, [3e30, -3e30]),
        (10, [1e9, 1e9]), (11, [1e9, -1e9]), (12, [-1e9, 2e9]),
    ]
    names = ("vector", "reach", "cluster", "distance", "inertia", "component", "rows", "total")
    df = table(spark, vectors).withColumns({c: F.lit(1) for c in names})
    for clusters in (2, 3, 20):
        assert found(df, clusters=clusters, rounds=3, width=2) == brute(vectors, 2, clusters, 3)
    assert found(df) == []
    assert queries.centroid_query(spark, "/root/testdata/sf0.001").count() > 0


def test_one_vector_for_all(spark):
    vectors = [(i, [0.5, 0.5]) for i in range(100)]
    assert found(table(spark, vectors), width=2) == brute(vectors, 2, 8, 10)


def test_pivots_save_distances():
    rng = np.random.default_rng(0)
    middle = rng.integers(-4000, 4000, (8, 64))
    matrix = middle[rng.integers(0, 8, 5000)] + rng.integers(-100, 100, (5000, 64))
    pivots = centroids.choose_pivots(matrix[:256].tolist())
    held = centroids.Centroids.of(middle.tolist(), pivots)
    best, least, made = held.nearest(matrix, centroids.to_pivots(matrix, pivots))
    apart = ((matrix[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (best == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()
    assert made < 2 * len(matrix)
