"""Writers: CSV tables, atomic table sets, named views and extracts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> int:
    """Write with a header and return the row count, observed while writing."""
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", '""')
        .csv(path)
    )
    return seen.get["rows"]


def write_csv_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    return {name: write_csv(df, f"{folder}/{name}.csv") for name, df in tables.items()}


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> str:
    """Replace a set of tables together, or not at all.

    Every table is first written to a folder of its own run. Readers follow one small manifest,
    which is renamed into place only after all writes succeeded, so a failure leaves the previous
    set in force and readers never see a mixture.
    """
    run = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/runs/{run}/{name}")
    replace_file(spark, f"{folder}/manifest.json", json.dumps({"run": run, "tables": sorted(tables)}))
    return run


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file if it is there."""
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, True)


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file and rename it into place, so readers see the old or the new one, whole."""
    fs, staged = _hadoop_path(spark, f"{path}-{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        staged.toUri(), spark._jsc.hadoopConfiguration()
    )
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Options.Rename, 1
    )
    options[0] = overwrite
    _, current = _hadoop_path(spark, path)
    context.rename(staged, current, options)


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the manifest currently in force."""
    text = spark.read.text(f"{folder}/manifest.json", wholetext=True).first()[0]
    manifest = json.loads(text)
    return {
        name: spark.read.parquet(f"{folder}/runs/{manifest['run']}/{name}")
        for name in manifest["tables"]
    }


def register_views(views: Mapping[str, DataFrame], prefix: str = "vw_") -> list[str]:
    """Make each result queryable by name; nothing runs until it is queried."""
    names = []
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def write_extracts(views: Mapping[str, DataFrame], folder: str) -> None:
    """One CSV file per view. Views are grouped reports of at most a few hundred rows, so a
    single output task is enough.
    """
    for name, df in views.items():
        write_csv(df.coalesce(1), f"{folder}/{name}.csv")
