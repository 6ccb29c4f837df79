"""Prefix scans over ranges of sorted rows, for keys of any size.

Rows are sorted by key and order into ranges of about equal size. A scan works inside each (key, range) and
carries the totals of a key's earlier ranges over the border, so neither a key nor an instant has to fit
into one task; what meets in one task is a row per range of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

RANGE = "_range"


def into_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = RANGE) -> DataFrame:
    """The rows with the number of their range, written once so that a retried task finds the same ranges."""
    ranged = df.repartitionByRange(*keys, *order)
    return stored(ranged.withColumn(name, F.spark_partition_id()), "ranges")


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    inclusive: bool = False,
    name: str = RANGE,
) -> DataFrame:
    """Add the sum of each column over the key's earlier rows, and the row itself if ``inclusive``.

    ``order`` must tell all rows of a key apart; ``name`` is the column of ``into_ranges``.
    """
    inside = [*keys, name]
    last = Window.currentRow if inclusive else -1
    within = Window.partitionBy(*inside).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    earlier = Window.partitionBy(*keys).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    carried = (
        df.groupBy(*inside)
        .agg(*[F.sum(column).alias(f"_{to}") for to, column in sums.items()])
        .select(*inside, *[F.coalesce(F.sum(f"_{to}").over(earlier), zero).alias(f"_{to}") for to in sums])
    )
    scanned = df.withColumns({to: F.coalesce(F.sum(column).over(within), zero) for to, column in sums.items()})
    total = lambda to, column: (F.col(to) + F.col(f"_{to}")).cast(_sum_type(df, column))
    return (
        scanned.join(carried, inside)
        .withColumns({to: total(to, column) for to, column in sums.items()})
        .drop(*[f"_{to}" for to in sums])
    )


def next_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, to: str, name: str = RANGE
) -> DataFrame:
    """Add the least ``value`` of the key's later rows (NULL when there is none); NULL values do not count.

    Meant for values that grow with the order, where the least one is the next one.
    """
    inside = [*keys, name]
    after = Window.partitionBy(*inside).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    later = Window.partitionBy(*keys).orderBy(name).rowsBetween(1, Window.unboundedFollowing)
    carried = (
        df.groupBy(*inside)
        .agg(F.min(value).alias("_least"))
        .select(*inside, F.min("_least").over(later).alias("_later"))
    )
    return (
        df.withColumn(to, F.min(value).over(after))
        .join(carried, inside)
        .withColumn(to, F.coalesce(to, "_later"))
        .drop("_later")
    )


def _sum_type(df: DataFrame, column: Column):
    return df.select(F.sum(column)).schema[0].dataType
