"""Session helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import run_dir

BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows, so long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = run_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a source table; extra columns are never read."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def whole(column: str):
    """A text, NULL read as empty."""
    return F.coalesce(F.col(column), F.lit(""))
