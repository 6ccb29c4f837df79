"""Currency-exchange users against the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import mean, pct
from tidemark.functions.text import segment_label
from tidemark.operators.accounts import account_facts, with_owner


def segment_averages(facts: DataFrame) -> DataFrame:
    return (
        facts.withColumn("customer_segment", segment_label(F.col("used_fx")))
        .groupBy("customer_segment")
        .agg(
            F.count("*").alias("customers"),
            mean(F.col("completed_transactions")).alias("avg_completed_transactions"),
            mean(F.col("volume_gbp")).alias("avg_transaction_volume_gbp"),
            mean(F.col("margin_gbp")).alias("avg_contribution_margin_gbp"),
        )
    )


def fx_against_rest(transactions: DataFrame) -> DataFrame:
    """Everyone with any transaction, whatever its status."""
    return segment_averages(account_facts(transactions)).orderBy(
        F.desc("avg_contribution_margin_gbp"), "customer_segment"
    )


def fx_customer_segments(transactions: DataFrame) -> DataFrame:
    """Only customers with a completed cash-in."""
    facts = account_facts(transactions).where(F.col("first_funding_ts").isNotNull())
    return segment_averages(facts)


def fx_share_by_channel(customers, accounts, transactions) -> DataFrame:
    users, everyone = F.count_if("used_fx"), F.count("*")
    return (
        with_owner(account_facts(transactions), accounts, customers)
        .groupBy("acquisition_channel")
        .agg(
            everyone.alias("funded_customers"),
            users.alias("fx_users"),
            pct(users, everyone).alias("fx_user_pct"),
        )
        .orderBy(F.desc("fx_user_pct"), "acquisition_channel")
    )
