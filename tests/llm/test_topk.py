"""Exact top-k against all scores."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA)


def brute(vectors, divisor, k):
    sound = {}
    for i, v in vectors:
        if i is None or v is None or any(x is None or not np.isfinite(np.float32(x)) for x in v):
            continue
        sound[i, tuple(int(np.floor(float(np.float32(x)) * 1024)) for x in v)] = None
    out = []
    for i, v in sound:
        if i % divisor == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in sound if j != i
            )[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_random_vectors_in_small_blocks(spark, seed):
    rng = random.Random(seed)
    # few values, so that ties and equal vectors are common
    vectors = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(3 + seed)]) for i in range(150)]
    rows = topk.integers(table(spark, vectors))
    asked = rows.where("vec_id % 10 = 0")
    assert found(topk.search(asked, rows, 7, entry_block=20, query_block=4)) == brute(vectors, 10, 7)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]),
        (5, [1.0]), (6, []), (7, [1.0, 2.0]), (8, [-3.0, 0.1]), (None, [1.0, 1.0]), (100, [0.0, 0.0]),
    ]
    df = table(spark, vectors).withColumns({c: F.lit(1) for c in ("vector", "part", "sheet", "ids", "score")})
    assert found(topk.search_every(df)) == brute(vectors, 100, 10)
    assert topk.search_every(df.limit(0)).count() == 0


def test_one_common_vector(spark):
    vectors = [(i, [1.0, 1.0]) for i in range(400)] + [(1000 + i, [2.0, i / 100]) for i in range(30)]
    assert found(topk.search_every(table(spark, vectors))) == brute(vectors, 100, 10)


def test_reading_stops_early():
    rng = np.random.default_rng(0)
    matrix = rng.integers(-50, 50, (5000, 4))
    matrix[17] = 5000
    query = np.array([3, 1, 2, 5])
    lists = topk.Lists(matrix)
    near = lists.best(query, 1)
    assert 17 in near and len(near) < 50
    for k in (1, 5, 40):
        scores = matrix @ query
        best = np.sort(scores)[-k]
        assert set(np.flatnonzero(scores >= best)) <= set(lists.best(query, k).tolist())


def test_scores_beyond_doubles_are_exact():
    big = 1 << 40
    matrix = np.array([[big, 1], [big, 0]])
    assert topk.scores(matrix, np.array([big, 1])) == [min(2**63 - 1, big * big + 1), min(2**63 - 1, big * big)]
    assert topk.scores(np.array([[1 << 27, 1]]), np.array([1 << 27, 1])) == [(1 << 54) + 1]
