"""Medians by refined histograms against sorted values."""

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles


@pytest.mark.parametrize("bins", [2, 3, 1024])
def test_medians_equal_sorted_values(spark, bins):
    rng = random.Random(bins)
    spread = {"a": 3, "b": 10**6, "c": 10**12, None: 50}
    rows = [(key, Decimal(rng.randrange(-top, top)) / 100) for key, top in spread.items() for _ in range(rng.randrange(1, 200))]
    rows += [("one", Decimal("-0.01")), ("same", Decimal(5)), ("same", Decimal(5)), ("none", None), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v decimal(14,2)")
    found = {r.k: r.m for r in quantiles.grouped_median(df, ["k"], F.col("v"), "m", bins=bins).collect()}
    for key in (*spread, "one", "same"):
        own = [v for k, v in rows if k == key and v is not None]
        assert found.pop(key) == pytest.approx(float(statistics.median(own)), abs=1e-9)
    assert found == {}


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, v decimal(14,2)")
    assert quantiles.grouped_median(df, ["k"], F.col("v")).count() == 0
