"""Headline figures and the presentation transforms of the dashboard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import completed, margin
from tidemark.functions.text import (
    FX_LABEL,
    NON_FX_LABEL,
    VARIANT_LABELS,
    WINDOW_LABELS,
    mapped,
    percent,
    pounds,
    pounds_millions,
    title_label,
)

KPI_COLUMNS = [
    "total_signups",
    "kyc_approved",
    "accounts_opened",
    "funded_customers",
    "transacting_customers",
    "total_transactions",
    "completed_transaction_volume_gbp",
    "total_contribution_margin_gbp",
]


def side_by_side(parts: list[DataFrame]) -> DataFrame:
    """Merge one-row frames with distinct columns into one row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def headline_kpis(customers, kyc_cases, accounts, product_events, transactions) -> DataFrame:
    """Eight headline numbers; one aggregate per table. Events are counted, not customers."""

    def named(event: str):
        return F.count_if(F.col("event_name") == event)

    parts = [
        customers.agg(F.count("*").alias("total_signups")),
        kyc_cases.agg(F.count_if(F.col("status") == "approved").alias("kyc_approved")),
        accounts.agg(F.count("*").alias("accounts_opened")),
        product_events.agg(
            named("first_funding").alias("funded_customers"),
            named("first_transaction").alias("transacting_customers"),
        ),
        transactions.agg(
            F.count("*").alias("total_transactions"),
            F.sum(F.when(completed(), F.col("amount_gbp"))).alias(
                "completed_transaction_volume_gbp"
            ),
            F.sum(F.when(completed(), margin())).alias("total_contribution_margin_gbp"),
        ),
    ]
    return side_by_side(parts).select(*KPI_COLUMNS)


def headline(kpis: DataFrame) -> DataFrame:
    """The KPI row as shown: conversion rate, millions and pounds as text."""
    conversion = F.try_divide(
        F.col("funded_customers").cast("double"), F.col("total_signups")
    ) * F.lit(100.0)
    return kpis.select(
        F.format_number("total_signups", 0).alias("signups"),
        F.format_number("funded_customers", 0).alias("funded_customers"),
        F.format_number("total_transactions", 0).alias("transactions"),
        pounds_millions(F.col("completed_transaction_volume_gbp")).alias("completed_volume"),
        percent(conversion, 1).alias("signup_to_funding"),
        F.format_number("kyc_approved", 0).alias("kyc_approved"),
        F.format_number("transacting_customers", 0).alias("transacting_customers"),
        pounds(F.col("total_contribution_margin_gbp"), 0).alias("contribution_margin"),
    )


# Column captions of the two dashboard tables.
CHANNEL_CAPTIONS = {
    "channel": "Channel",
    "signups": "Signups",
    "funded_customers": "Funded customers",
    "signup_to_funding_pct": "Signup → funding %",
    "cac_gbp": "CAC £",
    "cost_per_funded_customer_gbp": "Cost / funded £",
    "avg_transaction_volume_gbp": "Avg volume £",
    "avg_contribution_margin_gbp": "Avg margin £",
}
ECONOMICS_CAPTIONS = {
    "transaction_label": "Transaction type",
    "completed_transactions": "Completed transactions",
    "transaction_volume_gbp": "Volume £",
    "revenue_gbp": "Revenue £",
    "processing_cost_gbp": "Processing cost £",
    "contribution_margin_gbp": "Contribution margin £",
    "avg_margin_per_transaction_gbp": "Avg margin / transaction £",
}


def labelled_channels(performance: DataFrame) -> DataFrame:
    return performance.withColumn("channel", title_label(F.col("acquisition_channel")))


def channels_by_conversion(performance: DataFrame) -> DataFrame:
    return (
        labelled_channels(performance)
        .select("channel", "signup_to_funding_pct")
        .orderBy(F.desc("signup_to_funding_pct"), "channel")
    )


def channels_by_cost(performance: DataFrame) -> DataFrame:
    return (
        labelled_channels(performance)
        .select("channel", "cost_per_funded_customer_gbp")
        .orderBy(F.asc_nulls_last("cost_per_funded_customer_gbp"), "channel")
    )


def channel_table(performance: DataFrame) -> DataFrame:
    return (
        labelled_channels(performance)
        .select(*CHANNEL_CAPTIONS)
        .withColumnsRenamed(CHANNEL_CAPTIONS)
    )


def retention_long(cohorts: DataFrame) -> DataFrame:
    """One row per cohort and window, labelled for charting."""
    return (
        cohorts.withColumn("cohort", F.date_format("funding_cohort", "MMM yyyy"))
        .unpivot(["cohort"], list(WINDOW_LABELS), "metric", "retention_pct")
        .withColumn("metric", mapped(F.col("metric"), WINDOW_LABELS))
    )


def labelled_variants(performance: DataFrame) -> DataFrame:
    return performance.withColumn("variant_label", mapped(F.col("variant"), VARIANT_LABELS))


def fx_deltas(segments: DataFrame, retention: DataFrame) -> DataFrame:
    """Exchange users minus the rest, for activity, volume and retention (percentage points)."""

    def delta(column: str):
        def of(segment: str):
            return F.max(F.when(F.col("customer_segment") == segment, F.col(column)))

        return F.round(of(FX_LABEL) - of(NON_FX_LABEL), 2)

    return side_by_side(
        [
            segments.agg(
                delta("avg_completed_transactions").alias("completed_transactions_delta"),
                delta("avg_transaction_volume_gbp").alias("transaction_volume_delta_gbp"),
            ),
            retention.agg(delta("d30_retention_pct").alias("d30_retention_delta_pp")),
        ]
    )


def economics_by_margin(economics: DataFrame) -> DataFrame:
    return (
        economics.withColumn("transaction_label", title_label(F.col("transaction_type")))
        .select("transaction_label", "contribution_margin_gbp")
        .orderBy(F.desc("contribution_margin_gbp"), "transaction_label")
    )


def economics_table(economics: DataFrame) -> DataFrame:
    return (
        economics.withColumn("transaction_label", title_label(F.col("transaction_type")))
        .select(*ECONOMICS_CAPTIONS)
        .withColumnsRenamed(ECONOMICS_CAPTIONS)
    )
