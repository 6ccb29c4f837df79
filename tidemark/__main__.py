"""Load stored tables, check them, publish the extracts and show the experiment readout.

    python -m tidemark --tables FOLDER --extracts FOLDER [--format csv|parquet]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans.stored import StoredBank
from tidemark.sources import sinks


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True)
    parser.add_argument("--extracts", required=True)
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    load = StoredBank.from_csv if options.format == "csv" else StoredBank.from_parquet
    bank = load(spark, options.tables)
    broken = (
        quality.check_unique(bank.tables())
        .unionByName(quality.check_not_null(bank.tables()))
        .unionByName(quality.check_domains(bank.tables()))
        .unionByName(quality.check_ranges(bank.tables()))
        .unionByName(quality.check_foreign_keys(bank.tables()))
        .where(~F.col("passed"))
    )
    sinks.write_csv(broken, f"{options.extracts}/broken_checks.csv")
    bank.write_extracts(options.extracts)
    for name in ("exp_ztest", "exp_economics", "exp_decision"):
        bank.query(name).show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
