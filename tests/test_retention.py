"""Interval boundaries, thresholds and cut-offs of retention."""

import pytest

from tests.conftest import at, one, rows
from tidemark.operators import retention
from tidemark.operators.retention import RetentionRule, Window


def funded(account, day="2026-01-01"):
    return (account, day, "cash_in", "completed", 50)


def spent(account, ts, status="completed", kind="card_payment"):
    return (account, ts, kind, status, 5)


def windows(moves, account):
    counts = retention.activity_in_windows(
        retention.funded_anchors(moves),
        moves.where(retention.is_activity()),
        "account_id",
        "first_funding_ts",
        "transaction_ts",
        "transaction_id",
        "transactions",
        RetentionRule().windows,
    )
    row = one(counts.where(f"account_id = {account}"))
    return row["d30"], row["d60"]


@pytest.mark.parametrize(
    "ts, expected",
    [
        ("2026-01-30 23:59:59", (0, 0)),
        ("2026-01-31 00:00:00", (1, 0)),
        ("2026-03-01 23:59:59", (1, 0)),
        ("2026-03-02 00:00:00", (0, 1)),
        ("2026-03-31 23:59:59", (0, 1)),
        ("2026-04-01 00:00:00", (0, 0)),
    ],
)
def test_windows_are_half_open(tx, ts, expected):
    assert windows(tx(funded(1), spent(1, ts)), 1) == expected


def test_threshold_and_ignored_activity(tx):
    inside = [f"2026-02-{day:02d}" for day in (5, 6, 7)]
    moves = tx(
        funded(1),
        *[spent(1, d) for d in inside],
        funded(2),
        *[spent(2, d) for d in inside[:2]],
        spent(2, inside[2], "failed"),
        spent(2, inside[2], "reversed"),
        spent(2, inside[2], kind="cash_in"),
        funded(3),  # no activity at all: still in the denominator
        spent(4, inside[0]),  # never funded: not in it
    )
    cohort = one(retention.monthly_cohorts(moves))
    assert (cohort["funded_customers"], cohort["retained_d30"]) == (3, 1)
    assert cohort["d30_retention_pct"] == 33.33
    assert (cohort["retained_d60"], cohort["d60_retention_pct"]) == (0, 0.0)


def test_maturity_cutoff_is_inclusive(make, tx):
    moves = tx(funded(1, "2026-07-02 23:59:59"), funded(2, "2026-07-03 00:00:00"))
    people = make(
        "customers", *[dict(customer_id=i, acquisition_channel="organic") for i in (1, 2)]
    )
    holders = make("accounts", *[dict(account_id=i, customer_id=i) for i in (1, 2)])
    assert one(retention.d30_by_channel(people, holders, moves))["eligible_customers"] == 1
    assert one(retention.fx_retention(moves))["eligible_customers"] == 1


def test_cohorts_are_whole_months(tx):
    moves = tx(funded(1, "2026-05-31 23:59:59"), funded(2, "2026-06-01 00:00:00"))
    assert rows(retention.monthly_cohorts(moves), "funding_cohort") == [
        (at("2026-05-01").date(),)
    ]


def test_fx_use_counts_over_the_whole_life(tx):
    moves = tx(funded(1), spent(1, "2026-08-30", kind="fx_exchange"), funded(2))
    found = rows(retention.fx_retention(moves), "customer_segment", "eligible_customers")
    assert found == [("FX user", 1), ("Non-FX user", 1)]


def test_other_windows_and_names(tx):
    rule = RetentionRule(windows=(Window("w1", 1, 3),), min_events=1, as_of=at("2026-03-01"))
    moves = tx(funded(1), spent(1, "2026-01-02"), funded(2))
    found = one(retention.monthly_cohorts(moves, rule))
    assert found["retained_w1"] == 1 and found["w1_retention_pct"] == 50.0
