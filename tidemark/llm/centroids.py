"""Centroid clustering of integer vectors with a LAESA pivot table.

Vectors become integers, floor(scale * x). The distance of each vector to ``PIVOTS`` fixed pivots is computed
once and written with the vector. In each round the driver holds the k centroids and their distances to
the pivots; by the triangle inequality, the largest difference of pivot distances bounds a vector's distance
to a centroid from below. The centroid with the least bound gets an exact distance first; of the others,
those whose bound does not exceed it get theirs, and the rest cannot be nearest. Distances are exact integers
(squared Euclidean), so the pivots decide only how much is computed, never the result.

A round is one job over the written table: assignment and the sums of a batch in one Arrow pass, summed by
(cluster, component) before and after the shuffle; k times the width of numbers reach the driver. Nothing of
a round but the centroids is kept, so a lost executor costs its tasks of the round.

Vectors that are NULL, hold NULL or non-finite components, or have another width take no part. The first
centroids are the vectors of the k ids with smallest SHA-256 of ``3:<id>``; ties (repeated ids) go by vector, rows
without id come last. Repeated rows count each. With fewer rows than k there are fewer centroids; an empty
table gives no rows. Ties of distance go to the smaller centroid number; a centroid without vectors stays.
Components beyond 64 bits saturate, as do distances; everything below is exact. Further columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.spark import bound_batches, stored

SCALE = 1024
WIDTH = 64
CLUSTERS = 8
ROUNDS = 10
PIVOTS = 8
#: Rows, by hash, that pivots are chosen from; the bound of what the driver reads of them.
PIVOT_ROWS = 256
#: Rows of one exact step inside a task.
ROWS = 4_096
#: Components up to this give squared distances of 64 components within 64 bits.
SAFE = 1 << 27
TOP = (1 << 63) - 1
#: Share by which rounding may move a difference of two distances (generous; it costs no exactness).
SLACK = 1e-12


def integers(df: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id and the scaled integer vector of the rows that take part; repeated rows stay."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (
        df.where(F.size("embedding") == width)
        .where(sound)
        .select("vec_id", F.transform(wide, lambda x: F.floor(x * scale).cast("long")).alias("vector"))
    )


def _wide(matrix: np.ndarray, other: np.ndarray) -> bool:
    """Whether squared distances might leave 64 bits."""
    peak = lambda m: max(-int(m.min(initial=0)), int(m.max(initial=0)))
    return max(peak(matrix), peak(other)) > SAFE or matrix.shape[-1] > WIDTH


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to rows; Python integers where 64 bits do not hold them."""
    if _wide(left, right):
        left, right = left.astype(object), right.astype(object)
        return ((left - right) ** 2).sum(axis=1)
    apart = left - right
    return np.einsum("ij,ij->i", apart, apart)


def to_pivots(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, as doubles."""
    out = np.empty((len(matrix), len(pivots)))
    for p, pivot in enumerate(pivots):
        out[:, p] = np.sqrt(squared(matrix, pivot[None, :]).astype(np.float64))
    return out


@dataclass(frozen=True)
class Centroids:
    """The centroids of a round and their distances to the pivots."""

    vectors: np.ndarray
    reach: np.ndarray

    @classmethod
    def of(cls, vectors: list[list[int]], pivots: np.ndarray) -> Centroids:
        matrix = np.array(vectors, np.int64)
        return cls(matrix, to_pivots(matrix, pivots))

    def nearest(self, matrix: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid and squared distance of each row, and how many distances that took."""
        low = np.zeros((len(matrix), len(self.vectors)))
        for p in range(reach.shape[1]):
            a, b = reach[:, p, None], self.reach[None, :, p]
            np.maximum(low, np.abs(a - b) - SLACK * (a + b), out=low)
        rows = np.arange(len(matrix))
        best = low.argmin(axis=1)
        least = squared(matrix, self.vectors[best])
        bar = np.sqrt(least.astype(np.float64)) * (1 + SLACK)
        left = low <= bar[:, None]
        left[rows, best] = False
        made = len(matrix)
        for c in range(len(self.vectors)):
            at = np.flatnonzero(left[:, c])
            if not len(at):
                continue
            made += len(at)
            found = squared(matrix[at], self.vectors[c][None, :])
            wins = (found < least[at]) | ((found == least[at]) & (c < best[at]))
            least[at[wins]], best[at[wins]] = found[wins], c
        return best, least, made


def _matrices(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Vectors and pivot distances of a batch, some rows at a time."""
    vectors = batch.column("vector").flatten().to_numpy().reshape(-1, width)
    reach = batch.column("reach").flatten().to_numpy().reshape(len(batch), -1)
    for first in range(0, len(batch), ROWS):
        last = min(first + ROWS, len(batch))
        yield first, last, vectors[first:last], reach[first:last]


def choose_pivots(rows: list[list[int]], count: int = PIVOTS) -> np.ndarray:
    """Vectors far apart: each next one has the greatest sum of distances to those before."""
    matrix = np.array(rows, np.int64)
    total = np.zeros(len(matrix))
    chosen: list[int] = []
    for _ in range(min(count, len(matrix))):
        masked = total.copy()
        masked[chosen] = -1
        chosen.append(int(masked.argmax()))
        total += to_pivots(matrix, matrix[chosen[-1]][None, :])[:, 0]
    return matrix[chosen]


def pivot_table(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """The rows with their distances to the pivots (``reach``), written once."""
    schema = T.StructType([*rows.schema.fields, T.StructField("reach", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = batch.column("vector").flatten().to_numpy().reshape(-1, width)
            reach = to_pivots(matrix, pivots)
            offsets = pa.array(np.arange(len(batch) + 1) * len(pivots), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(reach.ravel()))], names=schema.names
            )

    return stored(rows.mapInArrow(run, schema), "pivots")


def _next(held: DataFrame, centroids: Centroids) -> list[list[int]]:
    """The centroids after a round: floors of means, those without vectors as they were."""
    width = centroids.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, matrix, reach in _matrices(batch, width):
                best, _, _ = centroids.nearest(matrix, reach)
                wide = int(np.abs(matrix.astype(np.float64)).max(initial=0)) > SAFE
                exact = matrix.astype(object) if wide else matrix
                found = np.unique(best)
                sums = [exact[best == c].sum(axis=0) for c in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.repeat(width), pa.int32()),
                        pa.array(np.tile(np.arange(width), len(found)), pa.int32()),
                        pa.array([Decimal(int(x)) for s in sums for x in s], pa.decimal128(38, 0)),
                        pa.array(np.array([(best == c).sum() for c in found]).repeat(width), pa.int64()),
                    ],
                    names=["cluster", "component", "total", "rows"],
                )

    kind = "cluster int, component int, total decimal(38,0), rows long"
    sums = (
        held.select("vector", "reach")
        .mapInArrow(run, kind)
        .groupBy("cluster", "component")
        .agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    )
    means = centroids.vectors.tolist()
    for cluster, component, total, rows in sums.collect():
        means[cluster][component] = int(total) // rows
    return means


def cluster(
    df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE
) -> tuple[DataFrame, list[list[int]]]:
    """Per vector: vec_id, vector, cluster, distance (squared); and the final centroids."""
    bound_batches(df.sparkSession)
    rows = integers(df, width, scale)
    spread = rows.orderBy(F.xxhash64("vector"), "vector").limit(PIVOT_ROWS)
    pivots = choose_pivots([list(r["vector"]) for r in spread.select("vector").collect()])
    out = T.StructType(
        [*rows.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )
    if not len(pivots):
        return rows.select("vec_id", "vector", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    held = pivot_table(rows, pivots, width)
    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    firsts = held.orderBy(order.asc_nulls_last(), "vec_id", "vector").limit(clusters).select("vector").collect()
    centroids = Centroids.of([list(r["vector"]) for r in firsts], pivots)
    for _ in range(rounds):
        centroids = Centroids.of(_next(held, centroids), pivots)
    final = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [final.nearest(m, r)[:2] for _, _, m, r in _matrices(batch, width)]
            best = np.concatenate([b for b, _ in parts]) if parts else np.empty(0, np.int64)
            least = [min(int(x), TOP) for _, least in parts for x in least]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("vector"),
                    pa.array(best, pa.int32()),
                    pa.array(least, pa.int64()),
                ],
                names=out.names,
            )

    return held.mapInArrow(run, out), final.vectors.tolist()


def told(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Per vector: vec_id, cluster, distance, the inertia of its cluster and of all, its centroid's digest.

    Inertias are sums by cluster, of which there are k, so they are broadcast; they saturate at 64 bits.
    """
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    sums = {r["cluster"]: int(r["inertia"]) for r in inertia}
    rows = [
        (
            c,
            min(sums.get(c, 0), TOP),
            min(sum(sums.values()), TOP),
            hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest(),
        )
        for c, centroid in enumerate(centroids)
    ]
    about = found.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
