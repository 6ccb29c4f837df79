"""A stored table whose partitions are replaced one by one, with readable snapshots.

Rows live in folders of the version that wrote them, split by partition values. A manifest per snapshot
names for each partition the version that holds it, its rows and a digest of them. A refresh writes only
partitions whose rows differ from what the current snapshot holds, then a new manifest, then renames one small
file that says which snapshot is current. Readers of an older snapshot keep their files until a vacuum.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.sinks import delete, exists, replace_file

NONE = "none"


class Snapshots:
    """A partitioned table in a folder; ``keys`` gives the partition values as expressions over its rows."""

    def __init__(self, spark: SparkSession, folder: str, keys: Mapping[str, Column]) -> None:
        self.spark, self.folder = spark, folder
        self.keys = {name: F.coalesce(value.cast("string"), F.lit(NONE)) for name, value in keys.items()}

    @property
    def current(self) -> int:
        """The number of the current snapshot; 0 before the first."""
        pointer = f"{self.folder}/CURRENT"
        return int(self.spark.read.text(pointer).first()[0]) if exists(self.spark, pointer) else 0

    def manifest(self, snapshot: int | None = None) -> DataFrame:
        """Partition values, version, rows and digest of every partition."""
        number = self.current if snapshot is None else snapshot
        return self.spark.read.parquet(f"{self.folder}/manifests/{number}")

    def refresh(self, df: DataFrame, scope: Column | None = None) -> int:
        """Replace the partitions in ``scope`` (a condition on partition values; all without) by the rows of ``df``.

        Returns how many partitions were written; those whose rows are the same stay as they are, and those
        that ``df`` has no rows of are gone. A first call makes the table.
        """
        before, names = self.current, list(self.keys)
        keyed = df.withColumns(self.keys)
        if scope is not None:
            keyed = keyed.where(scope)
        told = keyed.groupBy(*names).agg(
            F.count("*").alias("rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("digest")
        )
        version = F.lit(before + 1)
        if before:
            held = self.manifest(before)
            kept = held.where(~scope) if scope is not None else held.limit(0)
            same = held.select(*names, "rows", "digest", F.col("version").alias("_held"))
            told = told.join(same, [*names, "rows", "digest"], "left").withColumn("version", F.coalesce("_held", version))
            told = told.drop("_held").unionByName(kept)
        else:
            told = told.withColumn("version", version)
        path = f"{self.folder}/manifests/{before + 1}"
        told.select(*names, "version", "rows", "digest").coalesce(1).write.parquet(path)
        changed = self.spark.read.parquet(path).where(F.col("version") == version).select(*names)
        written = changed.count()
        if written:
            rows = keyed.join(changed, names, "left_semi")
            rows.repartition(*names).write.partitionBy(*names).parquet(f"{self.folder}/data/{before + 1}")
        schema = df.schema.json()
        replace_file(self.spark, f"{self.folder}/schema.json", schema)
        if self.current != before:
            raise RuntimeError("another refresh came first; try again")
        replace_file(self.spark, f"{self.folder}/CURRENT", str(before + 1))
        return written

    def read(self, snapshot: int | None = None) -> DataFrame:
        """The rows of a snapshot; the partitions of each version are pruned by its manifest."""
        number = self.current if snapshot is None else snapshot
        text = self.spark.read.text(f"{self.folder}/schema.json", wholetext=True).first()[0]
        schema = T.StructType.fromJson(json.loads(text))
        stored = T.StructType([*schema.fields, *(T.StructField(name, T.StringType()) for name in self.keys)])
        manifest = self.manifest(number)
        out = self.spark.createDataFrame([], schema)
        for (version,) in manifest.select("version").distinct().orderBy("version").collect():
            wanted = manifest.where(F.col("version") == version).select(*self.keys)
            rows = self.spark.read.schema(stored).parquet(f"{self.folder}/data/{version}")
            out = out.unionByName(rows.join(wanted, list(self.keys), "left_semi").select(*schema.names))
        return out

    def vacuum(self) -> list[int]:
        """Delete the snapshots before the current one and the versions that it has nothing of."""
        number = self.current
        used = {r.version for r in self.manifest(number).select("version").distinct().collect()}
        gone = [n for n in range(1, number) if n not in used]
        for n in range(1, number):
            delete(self.spark, f"{self.folder}/manifests/{n}")
        for n in gone:
            delete(self.spark, f"{self.folder}/data/{n}")
        return gone
