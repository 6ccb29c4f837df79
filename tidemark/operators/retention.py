"""Interval retention: did an anchored entity stay active in windows after its anchor?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import is_activity, pct
from tidemark.functions.text import segment_label
from tidemark.operators.accounts import account_facts
from tidemark.operators.skew import HOT_ROWS, spread_lookup


@dataclass(frozen=True)
class Window:
    """Days [first, end) after the anchor."""

    name: str
    first: int
    end: int


@dataclass(frozen=True)
class RetentionRule:
    """The default is three activities within days 30-59 and 60-89 of a window to Aug 2026."""

    windows: tuple[Window, ...] = (Window("d30", 30, 60), Window("d60", 60, 90))
    min_events: int = 3
    as_of: datetime = datetime(2026, 8, 31, 23, 59, 59)

    def matured_by(self, window: Window) -> Column:
        """Latest anchor whose window has ended by ``as_of``."""
        return _timestamp(self.as_of) - _days(window.end)

    def whole_months_before(self) -> Column:
        """Anchors strictly before this are in months fully observed through every window."""
        horizon = max(w.end for w in self.windows)
        return F.trunc(_timestamp(self.as_of) - _days(horizon), "MM").cast("timestamp_ntz")


def _timestamp(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def _days(n: int) -> Column:
    return F.expr(f"INTERVAL {n} DAYS")


def activity_in_windows(
    anchors: DataFrame,
    activity: DataFrame,
    key: str,
    anchor_ts: str,
    activity_ts: str,
    row_id: str,
    weight: str,
    windows: Sequence[Window],
    carry: Sequence[str] = (),
    summaries: Mapping[str, tuple[str, Column]] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Events per window for every anchor, zero where there are none.

    ``weight`` names the anchor column that counts the entity's rows; it steers the salting of
    busy entities and does not change the result. ``carry`` keeps columns of the anchor;
    ``summaries`` adds (activity column needed, aggregate) over the whole activity of the entity.
    """
    summaries = summaries or {}
    needed = [activity_ts, row_id, *[column for column, _ in summaries.values()]]
    at, since = F.col(activity_ts), F.col(anchor_ts)
    inside = [
        F.count_if((at >= since + _days(w.first)) & (at < since + _days(w.end))).alias(w.name)
        for w in windows
    ]
    kept = [F.max(c).alias(c) for c in carry]
    kept += [value.alias(name) for name, (_, value) in summaries.items()]
    joined = spread_lookup(
        anchors.select(key, anchor_ts, weight, *carry),
        activity.select(key, *dict.fromkeys(needed)),
        key,
        weight,
        row_id,
        hot_rows,
    )
    return joined.groupBy(key).agg(*kept, *inside)


def retained(counts: DataFrame, by: str, windows: Sequence[Window], min_events: int, total: str):
    """Per ``by`` group: entities, and number and share retained in each window."""
    whole = F.count("*")
    measures = [whole.alias(total)]
    for w in windows:
        hits = F.count_if(F.col(w.name) >= min_events)
        measures += [
            hits.alias(f"retained_{w.name}"),
            pct(hits, whole).alias(f"{w.name}_retention_pct"),
        ]
    return counts.groupBy(by).agg(*measures)


def funded_anchors(transactions: DataFrame) -> DataFrame:
    """Accounts with a first funding; one scan of the transactions."""
    return account_facts(transactions).where(F.col("first_funding_ts").isNotNull())


def _account_activity(
    anchors, transactions, windows, hot_rows, carry=(), summaries=None
) -> DataFrame:
    return activity_in_windows(
        anchors,
        transactions.where(is_activity()),
        key="account_id",
        anchor_ts="first_funding_ts",
        activity_ts="transaction_ts",
        row_id="transaction_id",
        weight="transactions",
        windows=windows,
        carry=carry,
        summaries=summaries,
        hot_rows=hot_rows,
    )


def d30_by_channel(
    customers, accounts, transactions, rule: RetentionRule = RetentionRule(), hot_rows=HOT_ROWS
) -> DataFrame:
    first = rule.windows[0]
    anchors = funded_anchors(transactions).where(
        F.col("first_funding_ts") <= rule.matured_by(first)
    )
    counts = _account_activity(anchors, transactions, [first], hot_rows)
    owners = accounts.select("account_id", "customer_id").join(
        customers.select("customer_id", "acquisition_channel"), "customer_id"
    )
    per_channel = retained(
        counts.join(owners, "account_id"),
        "acquisition_channel",
        [first],
        rule.min_events,
        "eligible_customers",
    )
    return per_channel.orderBy(F.desc(f"{first.name}_retention_pct"), "acquisition_channel")


def fx_retention(
    transactions, rule: RetentionRule = RetentionRule(), hot_rows=HOT_ROWS
) -> DataFrame:
    """First window by currency-exchange use; use counts over the whole life of the account.

    A completed exchange is activity, so use is read off the same joined rows and the anchors
    stay the same as for the other retention reports.
    """
    first = rule.windows[0]
    anchors = funded_anchors(transactions).where(
        F.col("first_funding_ts") <= rule.matured_by(first)
    )
    exchanged = F.coalesce(
        F.bool_or(F.col("transaction_type") == "fx_exchange"), F.lit(False)
    )
    counts = _account_activity(
        anchors,
        transactions,
        [first],
        hot_rows,
        summaries={"used_fx": ("transaction_type", exchanged)},
    )
    segmented = counts.withColumn("customer_segment", segment_label(F.col("used_fx")))
    return retained(
        segmented, "customer_segment", [first], rule.min_events, "eligible_customers"
    )


def monthly_cohorts(
    transactions, rule: RetentionRule = RetentionRule(), hot_rows=HOT_ROWS
) -> DataFrame:
    """Every window per month of first funding, for months observed through the last window."""
    anchors = (
        funded_anchors(transactions)
        .where(F.col("first_funding_ts") < rule.whole_months_before())
        .withColumn("funding_cohort", F.trunc("first_funding_ts", "MM"))
    )
    counts = _account_activity(
        anchors, transactions, rule.windows, hot_rows, carry=["funding_cohort"]
    )
    return retained(
        counts, "funding_cohort", rule.windows, rule.min_events, "funded_customers"
    ).orderBy("funding_cohort")
