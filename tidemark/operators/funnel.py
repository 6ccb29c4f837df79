"""Step funnels over any entity, and the onboarding funnel built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import pct


def reached_steps(
    entities: DataFrame,
    key: str,
    steps: Mapping[str, DataFrame],
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per entity: its ``by`` columns and one boolean per step it reached.

    ``steps`` map a name to any DataFrame with the key, repeats allowed. They are stacked as
    (key, bit) and combined with BIT_OR, so repeats collapse before the shuffle and no DISTINCT
    is needed; the buffer is a number, which keeps the aggregate hash-based. Without ``by`` the
    entities are one more bit of the same stack, otherwise they are joined one to one. Keys
    unknown to ``entities`` are dropped, entities without any step are kept.
    """

    def bit(i: int) -> Column:
        return F.lit(1 << i).cast("long")

    names = list(steps)
    parts = [steps[name].select(key, bit(i + 1).alias("_bits")) for i, name in enumerate(names)]
    if not by:
        parts.append(entities.select(key, bit(0).alias("_bits")))
    merged = (
        reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.bit_or("_bits").alias("_bits"))
    )
    if by:
        reached = entities.select(key, *by).join(merged, key, "left")
        reached = reached.withColumn("_bits", F.coalesce("_bits", F.lit(0).cast("long")))
    else:
        reached = merged.where(F.col("_bits").bitwiseAND(bit(0)) != 0)
    flags = [
        (F.col("_bits").bitwiseAND(bit(i + 1)) != 0).alias(name) for i, name in enumerate(names)
    ]
    return reached.select(key, *by, *flags)


def step_counts(
    entities: DataFrame,
    key: str,
    steps: Mapping[str, DataFrame],
    by: Sequence[str] = (),
    total: str = "entities",
) -> DataFrame:
    """How many entities reached each step, overall or per ``by`` group."""
    counts: list[Column] = [F.count("*").alias(total)]
    counts += [F.count_if(F.col(name)).alias(name) for name in steps]
    return reached_steps(entities, key, steps, by).groupBy(*by).agg(*counts)


def approved_cases(kyc_cases: DataFrame) -> DataFrame:
    return kyc_cases.where(F.col("status") == "approved")


def events_named(product_events: DataFrame, name: str) -> DataFrame:
    return product_events.where(F.col("event_name") == name)


def onboarding_funnel(customers, kyc_cases, accounts, product_events) -> DataFrame:
    steps = {
        "kyc_approved": approved_cases(kyc_cases),
        "accounts_opened": accounts,
        "first_funding": events_named(product_events, "first_funding"),
        "first_transaction": events_named(product_events, "first_transaction"),
    }
    return step_counts(customers, "customer_id", steps, total="signups")


def funnel_rates(funnel: DataFrame) -> DataFrame:
    """Conversion of each step from the one before it."""
    c = F.col
    return funnel.select(
        pct(c("kyc_approved"), c("signups")).alias("signup_to_kyc_pct"),
        pct(c("accounts_opened"), c("kyc_approved")).alias("kyc_to_account_pct"),
        pct(c("first_funding"), c("accounts_opened")).alias("account_to_funding_pct"),
        pct(c("first_transaction"), c("first_funding")).alias("funding_to_transaction_pct"),
    )


def kyc_by_channel(customers: DataFrame, kyc_cases: DataFrame) -> DataFrame:
    """Counts cases, not customers: customers without a case are left out."""
    cases = kyc_cases.groupBy("customer_id").agg(
        F.count("*").alias("cases"), F.count_if(F.col("status") == "approved").alias("approved")
    )
    per_channel = (
        customers.select("customer_id", "acquisition_channel")
        .join(cases, "customer_id")
        .groupBy("acquisition_channel")
        .agg(F.sum("cases").alias("signups"), F.sum("approved").alias("kyc_approved"))
    )
    return per_channel.withColumn(
        "kyc_approval_pct", pct(F.col("kyc_approved"), F.col("signups"))
    ).orderBy(F.desc("kyc_approval_pct"), "acquisition_channel")


def channel_funding(customers, accounts, product_events) -> DataFrame:
    """Signups, account holders and funded customers per acquisition channel."""
    steps = {
        "has_account": accounts,
        "funded": events_named(product_events, "first_funding"),
    }
    reached = reached_steps(customers, "customer_id", steps, by=["acquisition_channel"])
    return reached.groupBy("acquisition_channel").agg(
        F.count("*").alias("signups"),
        F.count_if("has_account").alias("accounts_opened"),
        F.count_if(F.col("has_account") & F.col("funded")).alias("funded_holders"),
        F.count_if("funded").alias("funded_customers"),
    )


def account_to_funding(customers, accounts, product_events) -> DataFrame:
    holders = channel_funding(customers, accounts, product_events).where("accounts_opened > 0")
    return holders.select(
        "acquisition_channel",
        "accounts_opened",
        F.col("funded_holders").alias("funded_customers"),
        pct(F.col("funded_holders"), F.col("accounts_opened")).alias("account_to_funding_pct"),
    ).orderBy(F.desc("account_to_funding_pct"), "acquisition_channel")


def signup_to_funding(customers: DataFrame, product_events: DataFrame) -> DataFrame:
    funded = {"funded_customers": events_named(product_events, "first_funding")}
    counts = step_counts(
        customers, "customer_id", funded, by=["acquisition_channel"], total="signups"
    )
    return counts.withColumn(
        "signup_to_funding_pct", pct(F.col("funded_customers"), F.col("signups"))
    ).orderBy(F.desc("signup_to_funding_pct"), "acquisition_channel")
