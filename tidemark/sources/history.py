"""Postings stored by account and read a page at a time.

Files hold ranges of (account, newest first) in small row groups. A manifest written beside them tells each
file's accounts, times and rows, so a page opens only the files that can hold it, and in them the row groups
whose minimum and maximum do. Pages go on from the last row seen (keyset paging), so a deep page costs as
much as the first one; an account of many files is read from the file where the page begins.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ["account_id", "created_at", "transfer_id"]
ROW_GROUP_BYTES = 1 << 20
#: A manifest of up to this many files is kept by the driver; a longer one is asked as a table.
HELD_FILES = 10_000
MANIFEST = "file string, place int, low string, high string, oldest timestamp_ntz, newest timestamp_ntz, rows long"


def write(posted: DataFrame, path: str, files: int | None = None) -> None:
    """Store postings ordered by account and newest first, with their manifest.

    The range is over (account, time), which also splits an account that would fill a file on its own.
    """
    order = ["account_id", F.desc("created_at"), F.desc("transfer_id")]
    ranges = [files, *order] if files else order
    spark = posted.sparkSession
    sorted_rows = posted.repartitionByRange(*ranges).sortWithinPartitions(*order)
    sorted_rows.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    told = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("account_id").alias("low"),
        F.max("account_id").alias("high"),
        F.min("created_at").alias("oldest"),
        F.max("created_at").alias("newest"),
        F.count("*").alias("rows"),
    )
    # files are numbered in the order of their ranges, which their names keep
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    told.select("file", number.alias("place"), "low", "high", "oldest", "newest", "rows").write.parquet(
        f"{path}/manifest"
    )


class History:
    """Pages of stored postings; the manifest is read once."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.schema = spark.read.parquet(f"{path}/postings").schema
        self.manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
        held = self.manifest.orderBy("place").limit(HELD_FILES + 1).collect()
        self._held = held if len(held) <= HELD_FILES else None

    def files(self, account_id: str, limit: int, before: datetime | None = None) -> list[str]:
        """Files in which the account's next ``limit`` rows, not newer than ``before``, are.

        Between the first and the last file of an account all rows are its own.
        """
        if self._held is not None:
            found = [f for f in self._held if f.low <= account_id <= f.high]
        else:
            account = F.lit(account_id)
            mine = self.manifest.where((F.col("low") <= account) & (F.col("high") >= account))
            whole = (F.col("low") == account) & (F.col("high") == account)
            if before is not None:
                mine = mine.where(~(whole & (F.col("oldest") > F.lit(before))))
            # files of fewer rows than a page are the exception: one file in two has rows enough
            found = mine.orderBy("place").limit(limit + 2).collect()
        out, rows = [], 0
        for f in found:
            whole = f.low == f.high
            if whole and before is not None and f.oldest > before:
                continue
            out.append(f.file)
            # rows as old as ``before`` may be newer in id, so a file that reaches it is not counted
            if whole and (before is None or f.newest < before):
                rows += f.rows
            if rows >= limit:
                break
        return out

    def page(
        self, account_id: str, limit: int = 20, before: tuple[datetime, str] | None = None
    ) -> DataFrame:
        """The account's newest rows, or those that follow the row (created_at, transfer_id) of ``before``."""
        files = self.files(account_id, limit, before and before[0])
        reader = self.spark.read.schema(self.schema)
        rows = reader.parquet(*files) if files else self.spark.createDataFrame([], self.schema)
        rows = rows.where(F.col("account_id") == F.lit(account_id))
        if before is not None:
            at, last = F.lit(before[0]).cast("timestamp_ntz"), F.lit(before[1])
            older = F.col("created_at") < at
            rows = rows.where(older | ((F.col("created_at") == at) & (F.col("transfer_id") < last)))
        return rows.orderBy(F.desc("created_at"), F.desc("transfer_id")).limit(limit)
