"""Building blocks that stay balanced when one key holds a large share of the rows.

A key is *hot* once it has ``HOT_ROWS`` rows. A table of N rows has at most N / HOT_ROWS hot
keys, which is what makes the list small enough to broadcast at any size of table: a trillion
rows bound it at a million keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
SALTS = 256
# Up to this rank Spark's own group limit is enough: every input partition keeps only that many
# rows per group before the shuffle, so even a group found in all of them stays small.
GROUP_LIMIT = 100


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, n) of the keys with at least ``hot_rows`` rows; counted map-side first."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= hot_rows)


def spread_lookup(
    lookup: DataFrame,
    fact: DataFrame,
    key: str,
    weight: str,
    row_id: str,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Left-join one lookup row per key to its many fact rows, spreading the hot keys.

    ``weight`` is a column of ``lookup`` holding the number of fact rows of the key. Fact rows
    of a hot key take a salt from ``row_id`` and its lookup row is repeated once per salt, so
    the key ends up in up to ``salts`` tasks; other keys use salt 0. Grouping the result by
    ``key`` afterwards aggregates before it shuffles, because the join is clustered by
    (key, salt) and not by key alone. A repeated lookup row may find no fact row in some salt,
    so aggregate with functions that ignore NULL fact columns. Lookup rows without a key are
    dropped; saying so up front lets both uses of ``lookup`` share one computation.
    """
    lookup = lookup.where(F.col(key).isNotNull())
    is_hot = F.col(weight) >= hot_rows
    marks = F.broadcast(lookup.where(is_hot).select(key, F.lit(True).alias("_hot")))
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")
    salted = (
        fact.join(marks, key, "left")
        .withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)))
        .drop("_hot")
    )
    every_salt = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    repeated = lookup.withColumn("_salt", F.explode(every_salt))
    return repeated.join(salted, [key, "_salt"], "left").drop("_salt")


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    last: int,
    row_id: str,
    rank: str = "rank",
    salts: int = SALTS,
) -> DataFrame:
    """The first ``last`` rows of every group in ``order``, numbered from 1 in ``rank``.

    No task ever holds a whole group. Small ranks rely on Spark's group limit, which trims each
    input partition before the shuffle. Larger ones rank within salted sub-groups first: a row
    among the first ``last`` of its group is among the first ``last`` of its sub-group too.
    """
    if last > GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(row_id), F.lit(salts))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_part_rank", F.row_number().over(part))
            .where(F.col("_part_rank") <= last)
            .drop("_salt", "_part_rank")
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= last)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], row_id: str
) -> DataFrame:
    """The earliest row of every key; each input partition sends one row per key."""
    return ranked(df, keys, [F.col(c) for c in order], 1, row_id, "_rank").drop("_rank")


def mark_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    limit: int,
    row_id: str,
    flag: str = "accepted",
) -> DataFrame:
    """Flag the first ``limit`` rows of every group, keeping all rows; NULL keys have no limit.

    Instead of ranking whole groups, find the ``limit``-th row of each (bounded by ``limit``
    rows per group) and compare. The join only looks up one row per group and nothing is
    grouped afterwards, so adaptive execution may split a skewed group freely.
    """
    at = F.struct(*order)
    columns = list(dict.fromkeys([*keys, *order, row_id]))
    grouped = df.select(*columns).dropna(subset=list(keys))
    cutoffs = (
        ranked(grouped, keys, [F.col(c) for c in order], limit, row_id)
        .where(F.col("rank") == limit)
        .select(*keys, at.alias("_cutoff"))
    )
    within = F.col("_cutoff").isNull() | (at <= F.col("_cutoff"))
    return df.join(cutoffs, list(keys), "left").withColumn(flag, within).drop("_cutoff")
