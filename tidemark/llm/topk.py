"""Exact top-k inner products by aggregation over sorted lists without random access.

Vectors become integers, floor(scale * x). Candidates with one vector are one entry that keeps its k+1
smallest ids: with ties going to smaller ids, and the query's own row left out, no other id of that
vector can be among k results. Entries and queries are dealt into blocks by hash, and a task gets one
block of queries and one of entries. There each component is a list sorted by value, read from the top
for positive query components and from the bottom for negative ones, a stretch of every list at a
time. An entry's lower bound takes the list's far end for components not yet read, its upper bound the
value that the list has reached. Reading stops when no outsider's upper bound reaches the k-th best
lower bound; the final scores of the entries left are resolved from their components. The k best of
each block meet in one aggregate per query.

Vectors that are NULL, or hold NULL or non-finite components, and rows without id, take no part.
A shorter vector counts as zero in the components it lacks. Scores are exact 64-bit integers; scores
beyond that range saturate. A row repeated with its id counts once. Fewer than k candidates are all
returned; no query or candidate rows give no results. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spark import bound_batches

SCALE = 1024
#: Entries of one block and queries of one block: the bound of what a task holds.
ENTRY_BLOCK = 4_096
QUERY_BLOCK = 4_096
#: Parts of a list that are read before bounds are looked at again.
STRETCHES = 4
EXACT = 1 << 53
FOUND = "query_id long, vector array<long>, vec_id long, score long"


def integers(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the scaled integer vector of the rows that take part."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (
        df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(sound)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(wide, lambda x: F.floor(x * scale).cast("long")).alias("vector"),
        )
        .distinct()
    )


class Lists:
    """A block of entries as one sorted list per component."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = matrix
        self.order = np.argsort(matrix, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(matrix, self.order.T, axis=0).T.astype(np.float64)
        self.size, self.width = matrix.shape

    def best(self, query: np.ndarray, k: int) -> np.ndarray:
        """Entries among which the k best by score are, ties included."""
        n, d = self.size, self.width
        if n <= k or not d:
            return np.arange(n)
        weight = query.astype(np.float64)
        down, up = np.flatnonzero(query <= 0), np.flatnonzero(query > 0)
        column = np.concatenate([down, up])[:, None]
        factor = weight[column]
        far = np.where(query > 0, self.values[:, 0], self.values[:, -1]) * weight
        partial = np.zeros(n)
        unread = np.ones((n, d))
        flat = unread.reshape(-1)
        read, stretch = 0, -(-n // STRETCHES)
        while read < n:
            stop = min(read + stretch, n)
            low, high = slice(read, stop), slice(n - stop, n - read)
            ids = np.concatenate([self.order[down, low], self.order[up, high]])
            got = np.concatenate([self.values[down, low], self.values[up, high]])
            got *= factor
            partial += np.bincount(ids.ravel(), got.ravel(), minlength=n)
            ids *= d
            ids += column
            flat[ids.ravel()] = 0
            read = stop
            if read == n:
                break
            reached = np.where(query > 0, self.values[:, n - stop], self.values[:, stop - 1]) * weight
            lower, upper = partial + (unread @ np.stack([far, reached], axis=1)).T
            bar = np.partition(lower, n - k)[n - k]
            inside = upper >= bar
            if np.count_nonzero(inside) <= 16 * k:
                return np.flatnonzero(inside)
        bar = np.partition(partial, n - k)[n - k]
        return np.flatnonzero(partial >= bar)


def scores(matrix: np.ndarray, query: np.ndarray) -> list[int]:
    """Exact integer inner products, saturating at 64 bits."""
    top, low = (1 << 63) - 1, -(1 << 63)
    return [
        max(low, min(top, sum(int(a) * int(b) for a, b in zip(row, query, strict=True))))
        for row in matrix
    ]


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


def search_block(queries: pa.Table, entries: pa.Table, k: int) -> pa.Table:
    """The k best entries of one block for each query of one block, spread over their ids."""
    asked, held = queries.column("vector").to_pylist(), entries.column("vector").to_pylist()
    ids = entries.column("ids").to_pylist()
    width = max(map(len, [*asked, *held]), default=0)
    wanted, matrix = _matrix(asked, width), _matrix(held, width)
    peak = lambda m: int(np.abs(m.astype(np.float64)).max(initial=0))
    safe = peak(wanted) * peak(matrix) * max(width, 1) < EXACT
    lists = Lists(matrix) if safe else None
    out = []
    for query_id, vector, query in zip(queries.column("vec_id").to_pylist(), asked, wanted, strict=True):
        # one more than k: the query's own row may be the best of its block
        near = lists.best(query, k + 1) if safe else np.arange(len(matrix))
        exact = (matrix[near] @ query).tolist() if safe else scores(matrix[near], query)
        rows = [
            (-score, vec_id)
            for entry, score in zip(near.tolist(), exact, strict=True)
            for vec_id in ids[entry]
            if vec_id != query_id
        ]
        out.extend((query_id, vector, vec_id, -score) for score, vec_id in sorted(rows)[:k])
    columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    return pa.Table.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
        names=["query_id", "vector", "vec_id", "score"],
    )


def search(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    entry_block: int = ENTRY_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score.

    Both sides are results of ``integers``. Two counts fix how many blocks there are.
    """
    bound_batches(queries.sparkSession)
    entries = candidates.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt")).agg(
        F.slice(F.array_sort(F.collect_set("vec_id")), 1, k + 1).alias("ids")
    )
    entries = entries.groupBy("vector").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids")
    )
    parts = max(1, -(-candidates.count() // entry_block))
    sheets = max(1, -(-queries.count() // query_block))
    share = lambda n: F.pmod(F.xxhash64("vector"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumn("sheet", F.pmod(F.xxhash64("vec_id"), F.lit(sheets)).cast("int"))
    asked = asked.withColumn("part", all_of(parts))
    held = entries.withColumn("part", share(parts)).withColumn("sheet", all_of(sheets))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_block(left, right, k)

    found = (
        asked.groupBy("sheet", "part").cogroup(held.groupBy("sheet", "part")).applyInArrow(run, FOUND)
    )
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def search_every(df: DataFrame, divisor: int = 100, k: int = 10) -> DataFrame:
    """The rows whose id the divisor divides, against all other rows."""
    rows = integers(df)
    return search(rows.where(F.col("vec_id") % divisor == 0), rows, k)
