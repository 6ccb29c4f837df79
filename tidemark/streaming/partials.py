"""Partial results of micro-batches, merged level by level behind a manifest.

Each micro-batch adds one folder. When a level has ``WIDTH`` folders they are merged into one of the next level,
so n batches leave at most ``WIDTH`` folders for each digit of n. The manifest names the folders in force and
the last batch that they hold; it is renamed into place after every write, so a failure leaves the folders
of before, and a repeated batch that is already held is not added again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.sinks import delete, exists, replace_file

WIDTH = 16


class Partials:
    """The partial results under a folder; ``merge`` makes one of several, in any order, with the same columns."""

    def __init__(
        self, spark: SparkSession, folder: str, merge: Callable[[DataFrame], DataFrame], width: int = WIDTH
    ) -> None:
        self.spark, self.folder, self.merge, self.width = spark, folder, merge, width
        self.manifest = f"{folder}/manifest.json"
        self.last, self.levels = -1, [[]]
        if exists(spark, self.manifest):
            held = json.loads(spark.read.text(self.manifest, wholetext=True).first()[0])
            self.last, self.levels = held["last"], held["levels"]

    def put(self, rows: DataFrame, number: int) -> None:
        """Add the partial result of a micro-batch, unless it is held already."""
        if number <= self.last:
            return
        levels = [list(level) for level in self.levels]
        levels[0].append(self._write(rows))
        gone: list[str] = []
        for n in range(len(levels)):
            if len(levels[n]) < self.width:
                break
            if n + 1 == len(levels):
                levels.append([])
            merged = self.merge(self._read(levels[n], rows)).select(*[F.col(f.name).cast(f.dataType) for f in rows.schema])
            levels[n + 1].append(self._write(merged.coalesce(1)))
            gone += levels[n]
            levels[n] = []
        replace_file(self.spark, self.manifest, json.dumps({"last": number, "levels": levels}))
        self.last, self.levels = number, levels
        for path in gone:
            delete(self.spark, path)

    def read(self, like: DataFrame) -> DataFrame:
        """All partial results merged; ``like`` has their columns."""
        paths = [path for level in self.levels for path in level]
        return self.merge(self._read(paths, like) if paths else like.limit(0))

    def _read(self, paths: list[str], like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(*paths)

    def _write(self, rows: DataFrame) -> str:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return path
