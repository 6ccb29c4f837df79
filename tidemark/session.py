"""Session set-up and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_ROOTS: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster an unset folder is
    an error, since data written to one machine is lost with it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = context.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the application's own part of the shared folder.

    Reruns never meet old files, and the application's part is deleted when its driver ends.
    """
    root = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _ROOTS.add(root)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
