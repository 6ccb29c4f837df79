"""Deriving the product event log from the tables it describes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import MONEY, is_activity
from tidemark.functions.text import zero_padded
from tidemark.operators.accounts import account_facts
from tidemark.operators.economics import first_fundings

TRANSACTION_EVENTS = ("first_funding", "first_transaction")
_KINDS = 8  # event_id = source id * 8 + kind, unique without numbering rows globally


def _event(df: DataFrame, kind: int, source_id, ts, name, session, value=None) -> DataFrame:
    amount = F.lit(None) if value is None else value
    return df.select(
        (F.col(source_id) * _KINDS + kind).alias("event_id"),
        "customer_id",
        F.col(ts).alias("event_ts"),
        name.alias("event_name"),
        session.alias("session_id"),
        amount.cast(MONEY).alias("event_value"),
    )


def _session_of(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("customer_id").cast("string"))


def lifecycle_events(customers, kyc_cases, accounts) -> DataFrame:
    """Signup, verification and account opening; needs no shuffle."""
    session = F.concat(F.lit("s"), zero_padded(F.col("customer_id"), 7))
    outcome = F.when(F.col("status") == "approved", "kyc_approved").otherwise("kyc_rejected")
    started = kyc_cases.where(F.col("started_ts").isNotNull())
    finished = kyc_cases.where(F.col("completed_ts").isNotNull())
    parts = [
        _event(customers, 0, "customer_id", "signup_ts", F.lit("signup_completed"), session),
        _event(started, 1, "kyc_case_id", "started_ts", F.lit("kyc_started"), session),
        _event(finished, 2, "kyc_case_id", "completed_ts", outcome, session),
        _event(accounts, 3, "customer_id", "opened_ts", F.lit("account_opened"), session),
    ]
    return reduce(DataFrame.unionByName, parts)


def first_funding_events(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    owned = first_fundings(transactions).join(
        accounts.select("account_id", "customer_id"), "account_id"
    )
    return _event(
        owned,
        4,
        "customer_id",
        "transaction_ts",
        F.lit("first_funding"),
        _session_of("funding-"),
        F.col("amount_gbp"),
    )


def first_transaction_events(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    firsts = account_facts(transactions.where(is_activity())).select(
        "account_id", "first_activity_ts"
    )
    owned = firsts.join(accounts.select("account_id", "customer_id"), "account_id")
    return _event(
        owned,
        5,
        "customer_id",
        "first_activity_ts",
        F.lit("first_transaction"),
        _session_of("txn-"),
    )


def transaction_events(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    return first_funding_events(accounts, transactions).unionByName(
        first_transaction_events(accounts, transactions)
    )


def refreshed_events(log: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Replace the transaction-derived events of ``log``; running it twice changes nothing."""
    kept = log.where(~F.col("event_name").isin(*TRANSACTION_EVENTS))
    return kept.unionByName(transaction_events(accounts, transactions))
