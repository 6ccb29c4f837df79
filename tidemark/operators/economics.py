"""Unit economics per transaction type, and the derivations that price a transaction."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fees import ACTIVATION_BONUS, fee_columns, quote_columns
from tidemark.functions.money import (
    SMALL_MONEY,
    completed,
    is_funding,
    margin,
    mean,
    revenue,
)
from tidemark.operators.skew import first_per_key

TYPE = "transaction_type"


def _total(value):
    return F.sum(F.when(completed(), value))


def revenue_by_type(transactions: DataFrame) -> DataFrame:
    """Types without a completed transaction are listed with 0 and NULL."""
    return (
        transactions.groupBy(TYPE)
        .agg(
            F.count_if(completed()).alias("completed_transactions"),
            _total(revenue()).alias("total_revenue_gbp"),
        )
        .orderBy(F.desc("total_revenue_gbp"), TYPE)
    )


def margin_by_type(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy(TYPE)
        .agg(_total(margin()).alias("contribution_margin_gbp"))
        .orderBy(F.desc("contribution_margin_gbp"), TYPE)
    )


def unit_margin(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy(TYPE)
        .agg(
            F.count_if(completed()).alias("completed_transactions"),
            mean(F.when(completed(), margin()), 4).alias("avg_margin_per_transaction_gbp"),
        )
        .orderBy(F.desc("avg_margin_per_transaction_gbp"), TYPE)
    )


def economics_measures():
    return [
        F.count_if(completed()).alias("completed_transactions"),
        _total(F.col("amount_gbp")).alias("transaction_volume_gbp"),
        _total(revenue()).alias("revenue_gbp"),
        _total(F.col("processing_cost_gbp")).alias("processing_cost_gbp"),
        _total(margin()).alias("contribution_margin_gbp"),
        mean(F.when(completed(), margin()), 4).alias("avg_margin_per_transaction_gbp"),
    ]


def transaction_economics(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(TYPE).agg(*economics_measures())


def with_fees(transactions: DataFrame) -> DataFrame:
    """Price each transaction by the fee schedule."""
    return transactions.withColumns(fee_columns())


def first_fundings(transactions: DataFrame) -> DataFrame:
    """The earliest completed cash-in of every account, ties by transaction_id."""
    cash_in = transactions.where(is_funding()).select(
        "account_id", "transaction_ts", "transaction_id", "amount_gbp"
    )
    return first_per_key(cash_in, ["account_id"], ["transaction_ts", "transaction_id"], "transaction_id")


def with_incentive(
    transactions: DataFrame, accounts: DataFrame, assignments: DataFrame, variant: str = "bonus_10"
) -> DataFrame:
    """Charge the activation bonus to the first funding of every customer in ``variant``.

    Only completed cash-ins can carry it, so only they are shuffled, by transaction_id, which is
    unique and spreads evenly however busy an account is. The rest pass straight through.
    """
    treated = assignments.where(F.col("variant") == variant).select("customer_id").distinct()
    bonus = (
        first_fundings(transactions)
        .join(accounts.select("account_id", "customer_id"), "account_id")
        .join(treated, "customer_id", "left_semi")
        .select("transaction_id", F.lit(ACTIVATION_BONUS).cast(SMALL_MONEY).alias("_bonus"))
    )
    nothing = F.lit("0.00").cast(SMALL_MONEY)
    can_carry = F.coalesce(is_funding(), F.lit(False))
    fundings = (
        transactions.where(can_carry)
        .join(bonus, "transaction_id", "left")
        .withColumn("incentive_cost_gbp", F.coalesce("_bonus", nothing))
        .drop("_bonus")
    )
    rest = transactions.where(~can_carry).withColumn("incentive_cost_gbp", nothing)
    return rest.unionByName(fundings)


def card_details(wide: DataFrame) -> DataFrame:
    return wide.where(F.col(TYPE) == "card_payment").select(
        "transaction_id", "merchant_category", "merchant_country", "card_present"
    )


def transfer_details(wide: DataFrame) -> DataFrame:
    """SWIFT where asked for, else the domestic rail for GBP accounts and SEPA for the rest."""
    rail = (
        F.when(F.col("is_swift"), "swift")
        .when(F.col("base_currency") == "GBP", "faster_payments")
        .otherwise("sepa")
    )
    return wide.where(F.col(TYPE) == "bank_transfer").select(
        "transaction_id", "direction", rail.alias("transfer_rail"), "counterparty_country"
    )


def fx_details(wide: DataFrame) -> DataFrame:
    """Currency exchanges with both amounts and the quoted rate."""
    quote = quote_columns(F.col("amount_gbp"), F.col("base_currency"), F.col("target_currency"))
    return wide.where(F.col(TYPE) == "fx_exchange").select(
        "transaction_id",
        F.col("base_currency").alias("from_currency"),
        F.col("target_currency").alias("to_currency"),
        *[value.alias(name) for name, value in quote.items()],
    )


def subtype_coverage(transactions: DataFrame, details: dict[str, DataFrame]) -> DataFrame:
    """Per type that has a detail table: transactions without a detail row and the reverse.

    Both sides are stacked and compared by one aggregate over the transaction id.
    """
    kinds = transactions.where(F.col(TYPE).isin(*details)).select(
        "transaction_id", TYPE, F.lit(1).alias("_moves"), F.lit(0).alias("_details")
    )
    sides = [
        rows.select(
            "transaction_id",
            F.lit(kind).alias(TYPE),
            F.lit(0).alias("_moves"),
            F.lit(1).alias("_details"),
        )
        for kind, rows in details.items()
    ]
    per_id = (
        reduce(DataFrame.unionByName, sides, kinds)
        .groupBy(TYPE, "transaction_id")
        .agg(F.sum("_moves").alias("_moves"), F.sum("_details").alias("_details"))
    )
    return per_id.groupBy(TYPE).agg(
        F.sum("_moves").alias("transactions"),
        F.sum("_details").alias("detail_rows"),
        F.count_if(F.col("_details") == 0).alias("without_detail"),
        F.count_if(F.col("_moves") == 0).alias("without_transaction"),
    )


def tenure(accounts: DataFrame, as_of: datetime) -> DataFrame:
    """Whole days from opening to ``as_of``, at least one."""
    end = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", F.col("opened_ts"), end)
    days = F.greatest(F.lit(1).cast("long"), F.floor(seconds / 86_400))
    return accounts.select("account_id", days.alias("days_available"))
