"""The per-account summary most analyses start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import (
    MONEY,
    completed,
    is_activity,
    is_funding,
    is_fx,
    margin,
)


def account_facts(transactions: DataFrame) -> DataFrame:
    """One row per account with transactions: one scan, one map-side-combined shuffle.

    Callers use a few of these columns; the optimizer drops the others from the aggregate and
    from the scan. Every buffer is of fixed width, so the aggregate stays hash-based.
    Money sums are NULL where no transaction qualifies.
    """
    done = completed()

    def total(value, condition):
        return F.sum(F.when(condition, value))

    measures = [
        F.count("*").alias("transactions"),
        F.count_if(done).alias("completed_transactions"),
        total(F.col("amount_gbp"), done).alias("volume_gbp"),
        total(margin(), done).alias("margin_gbp"),
        F.sum(margin()).alias("margin_any_status_gbp"),
        F.bool_or(is_fx()).alias("used_fx"),
        F.min(F.when(is_funding(), F.col("transaction_ts"))).alias("first_funding_ts"),
        F.min(F.when(is_activity(), F.col("transaction_ts"))).alias("first_activity_ts"),
    ]
    if "incentive_cost_gbp" in transactions.columns:
        measures.append(
            total(F.col("incentive_cost_gbp"), done).cast(MONEY).alias("incentive_gbp")
        )
    return transactions.groupBy("account_id").agg(*measures)


def with_owner(facts: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Add customer_id and acquisition channel; all three sides are unique on their join key."""
    owners = accounts.select("account_id", "customer_id")
    channels = customers.select("customer_id", "acquisition_channel")
    return facts.join(owners, "account_id").join(channels, "customer_id")
