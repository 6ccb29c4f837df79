"""Typed readers: CSV, parquet, catalog tables and databases."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import EXTRACTS, TABLES


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] = ()
) -> DataFrame:
    """Header row, empty field = NULL, malformed rows fail the read; a missing path raises.

    Never infers types, so the files are scanned once. Only ``columns`` are parsed when given.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )
    return df.select(*columns) if columns else df


def read_csv_tables(
    spark: SparkSession, folder: str, names: Sequence[str]
) -> dict[str, DataFrame]:
    return {n: read_csv(spark, f"{folder}/{n}.csv", TABLES[n].schema) for n in names}


def read_extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The published extracts by name."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", ddl) for name, ddl in EXTRACTS.items()}


def read_parquet_tables(
    spark: SparkSession, folder: str, names: Sequence[str]
) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    low: int,
    high: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table read in parallel ranges of a numeric key."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=low,
        upperBound=high,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def transfer_series(
    numbers: DataFrame, column: str = "id", accounts: int = 1000, base: str = "2026-01-01 00:00:00"
) -> DataFrame:
    """Deterministic transfers from a column of integers: md5 ids around a ring of accounts."""
    n = F.col(column)

    def as_uuid(value: Column) -> Column:
        digits = F.md5(value.cast("string"))
        sizes = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
        return F.concat_ws("-", *[F.substring(digits, at, size) for at, size in sizes])

    return numbers.select(
        as_uuid(n).alias("transfer_id"),
        as_uuid(n % accounts).alias("source_account_id"),
        as_uuid((n + 1) % accounts).alias("destination_account_id"),
        F.lit(100).cast("bigint").alias("amount_minor"),
        F.lit("GBP").alias("currency"),
        F.timestamp_add("SECOND", n, F.lit(base).cast("timestamp_ntz")).alias("created_at"),
    )


def series_account(number: int) -> str:
    """Account id of ring position ``number`` in :func:`transfer_series`."""
    return str(uuid.UUID(hashlib.md5(str(number).encode()).hexdigest()))
