"""A corpus pipeline over ``documents``: toxicity, line dedup, near-duplicate dedup, packing.

``STAGES`` lists (name, function). A function takes the session, the documents left by the stage before it
and the folder of source tables; all but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import linechunks, neardup, packing, toxicity
from tidemark.llm.spark import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine does not reject, unchanged."""
    machine = toxicity.train_open(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.score(docs, machine)
    return scored.where(F.col("predicted") == 0).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated runs of lines after their first place."""
    return linechunks.dedup(docs).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, unchanged."""
    return neardup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences that the documents left are packed into."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-duplicate dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL cannot express the stages' methods; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
