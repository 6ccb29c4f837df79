"""Acquisition cost and value per channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import mean, pct, per
from tidemark.operators.accounts import account_facts, with_owner
from tidemark.operators.funnel import signup_to_funding

CHANNEL = "acquisition_channel"


def spend_by_channel(marketing_spend: DataFrame) -> DataFrame:
    return marketing_spend.groupBy(CHANNEL).agg(F.sum("spend_gbp").alias("total_spend_gbp"))


def acquisition_cost(customers: DataFrame, marketing_spend: DataFrame) -> DataFrame:
    """Spend per signup; channels without spend are left out."""
    signups = customers.groupBy(CHANNEL).agg(F.count("*").alias("customers_acquired"))
    cost = per(F.col("total_spend_gbp"), F.col("customers_acquired")).alias("cac_gbp")
    return (
        signups.join(spend_by_channel(marketing_spend), CHANNEL)
        .select(CHANNEL, "customers_acquired", "total_spend_gbp", cost)
        .orderBy("cac_gbp", CHANNEL)
    )


def cost_per_funded(customers, product_events, marketing_spend) -> DataFrame:
    """Spend per funded customer; NULL for a channel that has spend but no funded customer."""
    funded = signup_to_funding(customers, product_events).select(CHANNEL, "funded_customers")
    cost = per(F.col("total_spend_gbp"), F.col("funded_customers"))
    return (
        funded.join(spend_by_channel(marketing_spend), CHANNEL)
        .select(
            CHANNEL,
            "funded_customers",
            "total_spend_gbp",
            cost.alias("cost_per_funded_customer_gbp"),
        )
        .orderBy(F.asc_nulls_last("cost_per_funded_customer_gbp"), CHANNEL)
    )


def _owned(customers, accounts, transactions) -> DataFrame:
    return with_owner(account_facts(transactions), accounts, customers)


def average_volume(customers, accounts, transactions) -> DataFrame:
    """Completed volume per customer with any completed transaction."""
    return (
        _owned(customers, accounts, transactions)
        .where("completed_transactions > 0")
        .groupBy(CHANNEL)
        .agg(
            F.count("*").alias("funded_customers"),
            mean(F.col("volume_gbp")).alias("avg_transaction_volume_gbp"),
        )
        .orderBy(F.desc("avg_transaction_volume_gbp"), CHANNEL)
    )


def average_frequency(customers, accounts, transactions) -> DataFrame:
    return (
        _owned(customers, accounts, transactions)
        .where("completed_transactions > 0")
        .groupBy(CHANNEL)
        .agg(
            F.count("*").alias("funded_customers"),
            mean(F.col("completed_transactions")).alias("avg_completed_transactions"),
        )
        .orderBy(F.desc("avg_completed_transactions"), CHANNEL)
    )


def _margin_column(completed_only: bool):
    return F.col("margin_gbp" if completed_only else "margin_any_status_gbp")


def average_margin(customers, accounts, transactions, completed_only: bool = False) -> DataFrame:
    """Margin per customer with any transaction; by default every status counts."""
    return (
        _owned(customers, accounts, transactions)
        .groupBy(CHANNEL)
        .agg(
            F.count("*").alias("funded_customers"),
            mean(_margin_column(completed_only)).alias("avg_contribution_margin_gbp"),
        )
        .orderBy(F.desc("avg_contribution_margin_gbp"), CHANNEL)
    )


def total_margin(customers, accounts, transactions, completed_only: bool = False) -> DataFrame:
    return (
        _owned(customers, accounts, transactions)
        .groupBy(CHANNEL)
        .agg(F.sum(_margin_column(completed_only)).alias("total_contribution_margin_gbp"))
        .orderBy(F.desc("total_contribution_margin_gbp"), CHANNEL)
    )


def net_contribution(
    customers, accounts, transactions, marketing_spend, completed_only: bool = False
) -> DataFrame:
    """Margin less acquisition spend; channels without spend are left out."""
    margins = total_margin(customers, accounts, transactions, completed_only)
    net = F.col("total_margin_gbp") - F.col("acquisition_spend_gbp")
    return (
        margins.withColumnRenamed("total_contribution_margin_gbp", "total_margin_gbp")
        .join(
            spend_by_channel(marketing_spend).withColumnRenamed(
                "total_spend_gbp", "acquisition_spend_gbp"
            ),
            CHANNEL,
        )
        .select(
            CHANNEL,
            "total_margin_gbp",
            "acquisition_spend_gbp",
            net.alias("net_contribution_after_acquisition_gbp"),
        )
        .orderBy(F.desc("net_contribution_after_acquisition_gbp"), CHANNEL)
    )


def channel_performance(
    customers, accounts, product_events, transactions, marketing_spend
) -> DataFrame:
    """Conversion, cost and average value per channel; inner over all three parts."""
    value = (
        _owned(customers, accounts, transactions)
        .groupBy(CHANNEL)
        .agg(
            mean(F.col("volume_gbp")).alias("avg_transaction_volume_gbp"),
            mean(F.col("margin_gbp")).alias("avg_contribution_margin_gbp"),
        )
    )
    spend = F.col("total_spend_gbp")
    return (
        signup_to_funding(customers, product_events)
        .join(spend_by_channel(marketing_spend), CHANNEL)
        .join(value, CHANNEL)
        .select(
            CHANNEL,
            "signups",
            "funded_customers",
            pct(F.col("funded_customers"), F.col("signups")).alias("signup_to_funding_pct"),
            spend.alias("acquisition_spend_gbp"),
            per(spend, F.col("signups")).alias("cac_gbp"),
            per(spend, F.col("funded_customers")).alias("cost_per_funded_customer_gbp"),
            "avg_transaction_volume_gbp",
            "avg_contribution_margin_gbp",
        )
    )
