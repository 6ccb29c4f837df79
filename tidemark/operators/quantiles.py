"""Exact medians of groups of any size, by histograms that are refined until a bin is one value.

A scan finds each group's least and greatest value and its rows. Every further scan counts the values between
the bounds in ``BINS`` bins, before the shuffle, and keeps the bin that holds the wanted rank. So what is
shuffled and what meets in one task is a number per bin, never a group's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

BINS = 1024


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: Column, to: str = "median", per_unit: int = 100, bins: int = BINS
) -> DataFrame:
    """The median of each group as a double: the middle value, or the mean of the middle two.

    ``value`` is exact to one part in ``per_unit``, such as pence. NULL values do not count; groups without
    values have no row. NULL keys are groups of their own.
    """
    names = [f"_k{n}" for n in range(len(keys))]
    groups = [F.col(key).alias(name) for key, name in zip(keys, names, strict=True)]
    rows = df.select(*groups, (value * per_unit).cast("long").alias("_v")).where(F.col("_v").isNotNull())
    count = F.count("*").alias("_n")
    bounds = rows.groupBy(*names).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), count)
    ranks = F.array_distinct(F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)))
    left = F.lit(0).cast("long").alias("_before")
    open_ = stored(bounds.select(*names, "_low", "_high", F.explode(ranks).alias("_rank"), left), "bounds")
    found = []
    while True:
        # a bin of one value is found
        found.append(open_.where("_low = _high").select(*names, "_low"))
        wide = open_.where("_low < _high")
        if wide.isEmpty():
            break
        width = F.ceil((F.col("_high") - F.col("_low") + 1) / bins).cast("long")
        wanted = wide.withColumn("_width", width).withColumnsRenamed({name: f"{name}w" for name in names})
        same = [F.col(name).eqNullSafe(F.col(f"{name}w")) for name in names]
        inside = F.col("_v").between(F.col("_low"), F.col("_high"))
        place = F.floor((F.col("_v") - F.col("_low")) / F.col("_width")).cast("long").alias("_bin")
        held = [*names, "_low", "_high", "_rank", "_before", "_width"]
        counted = rows.join(wanted, [*same, inside]).groupBy(*held, place).agg(count)
        upto = Window.partitionBy(*names, "_rank").orderBy("_bin")
        summed = F.col("_before") + F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, -1))
        start = F.coalesce(summed, F.col("_before"))
        low = F.col("_low") + F.col("_bin") * F.col("_width")
        open_ = stored(
            counted.withColumn("_start", start)
            .where(F.col("_rank").between(F.col("_start"), F.col("_start") + F.col("_n") - 1))
            .select(
                *names,
                low.alias("_low"),
                F.least(low + F.col("_width") - 1, F.col("_high")).alias("_high"),
                "_rank",
                F.col("_start").alias("_before"),
            ),
            "bounds",
        )
    middle = found[0]
    for part in found[1:]:
        middle = middle.unionByName(part)
    # one or two middle values of each group
    mean = F.sum(F.col("_low").cast("decimal(38,0)")).cast("double") / (F.count("*") * per_unit)
    shown = [F.col(name).alias(key) for key, name in zip(keys, names, strict=True)]
    return middle.groupBy(*names).agg(mean.alias(to)).select(*shown, to)
