"""Funnel, channel and segment rules on hand-made edge cases."""

from decimal import Decimal

import pytest

from tests.conftest import at, one, rows
from tidemark.functions.money import per
from tidemark.operators import channels, economics, funnel, segments
from tidemark.operators.accounts import account_facts


@pytest.fixture(scope="module")
def people(make):
    return make(
        "customers",
        *[dict(customer_id=i, acquisition_channel=c) for i, c in enumerate("aabbc", 1)],
    )


@pytest.fixture(scope="module")
def cases(make):
    # Customer 3 has two cases, customer 5 none.
    status = [(1, 1, "approved"), (2, 2, "rejected"), (3, 3, "abandoned"), (4, 3, "approved")]
    status.append((5, 4, "approved"))
    return make(
        "kyc_cases", *[dict(kyc_case_id=k, customer_id=c, status=s) for k, c, s in status]
    )


@pytest.fixture(scope="module")
def accounts(make):
    return make("accounts", *[dict(account_id=100 + c, customer_id=c) for c in (1, 3, 4)])


@pytest.fixture(scope="module")
def log(make):
    # Three repeats for customer 1, an event of an unknown customer, a funded non-holder.
    events = [(1, "first_funding")] * 3 + [(9, "first_funding"), (2, "first_funding")]
    events += [(1, "first_transaction"), (3, "first_transaction")]
    return make(
        "product_events",
        *[dict(event_id=i, customer_id=c, event_name=n) for i, (c, n) in enumerate(events)],
    )


def test_funnel_counts_each_customer_once(people, cases, accounts, log):
    steps = one(funnel.onboarding_funnel(people, cases, accounts, log))
    assert steps == dict(
        signups=5, kyc_approved=3, accounts_opened=3, first_funding=2, first_transaction=2
    )


def test_funnel_rates_are_step_to_step(people, cases, accounts, log):
    rates = one(funnel.funnel_rates(funnel.onboarding_funnel(people, cases, accounts, log)))
    assert rates == dict(
        signup_to_kyc_pct=60.0,
        kyc_to_account_pct=100.0,
        account_to_funding_pct=66.67,
        funding_to_transaction_pct=100.0,
    )


def test_empty_funnel_has_null_rates(people, cases, accounts, log):
    nobody = people.limit(0)
    rates = one(funnel.funnel_rates(funnel.onboarding_funnel(nobody, cases, accounts, log)))
    assert set(rates.values()) == {None}


def test_kyc_counts_cases_and_drops_customers_without(people, cases):
    assert rows(funnel.kyc_by_channel(people, cases)) == [
        ("a", 2, 1, 50.0),
        ("b", 3, 2, 66.67),
    ]


def test_holders_without_events_are_not_funded(people, accounts, log):
    assert rows(funnel.account_to_funding(people, accounts, log)) == [
        ("a", 1, 1, 100.0),
        ("b", 2, 0, 0.0),
    ]


def test_signup_to_funding_keeps_every_signup(people, log):
    assert rows(funnel.signup_to_funding(people, log)) == [
        ("a", 2, 2, 100.0),
        ("b", 2, 0, 0.0),
        ("c", 1, 0, 0.0),
    ]


@pytest.fixture(scope="module")
def spend(make):
    return make(
        "marketing_spend",
        dict(spend_month=at("2026-01-01").date(), acquisition_channel="a", spend_gbp="10.01"),
        dict(spend_month=at("2026-02-01").date(), acquisition_channel="a", spend_gbp="10.00"),
        dict(spend_month=at("2026-01-01").date(), acquisition_channel="b", spend_gbp="7.00"),
    )


def test_channel_without_spend_is_dropped(people, spend):
    found = rows(channels.acquisition_cost(people, spend), "acquisition_channel", "cac_gbp")
    assert found == [("a", 10.01), ("b", 3.5)]


def test_no_funded_customer_gives_null_cost(people, log, spend):
    found = rows(
        channels.cost_per_funded(people, log, spend),
        "acquisition_channel",
        "cost_per_funded_customer_gbp",
    )
    assert found == [("a", 10.01), ("b", None)]


MARGIN = dict(fee_revenue_gbp="1.00", processing_cost_gbp="0.25")
FAILED = dict(processing_cost_gbp="0.01")


def test_status_filter_differs_between_queries_and_views(people, accounts, tx, spend, log):
    moves = tx(
        (101, "2026-01-01", "cash_in", "completed", 10, MARGIN),
        (101, "2026-01-02", "card_payment", "failed", 5, FAILED),
    )
    every = one(channels.average_margin(people, accounts, moves))
    done = one(channels.average_margin(people, accounts, moves, completed_only=True))
    assert every["avg_contribution_margin_gbp"] == 0.74
    assert done["avg_contribution_margin_gbp"] == 0.75
    view = one(channels.channel_performance(people, accounts, log, moves, spend))
    assert view["avg_contribution_margin_gbp"] == 0.75


def test_fx_segments(tx):
    moves = tx(
        (1, "2026-01-01", "cash_in", "completed", 10, MARGIN),
        (1, "2026-01-02", "fx_exchange", "failed", 5, FAILED),  # failed only: not a user
        (2, "2026-01-02", "fx_exchange", "completed", 5, MARGIN),  # user, but never funded
    )
    everyone = rows(segments.fx_against_rest(moves), "customer_segment", "customers")
    assert everyone == [("FX user", 1), ("Non-FX user", 1)]
    funded = rows(segments.fx_customer_segments(moves), "customer_segment", "customers")
    assert funded == [("Non-FX user", 1)]


def test_type_without_completed_transactions_is_listed(tx):
    moves = tx((1, "2026-01-01", "cash_in", "failed", 10, FAILED))
    assert rows(economics.revenue_by_type(moves)) == [("cash_in", 0, None)]
    assert rows(economics.margin_by_type(moves)) == [("cash_in", None)]
    assert rows(economics.unit_margin(moves)) == [("cash_in", 0, None)]


def test_account_facts_use_hash_aggregation(tx):
    moves = tx((1, "2026-01-01", "cash_in", "completed", 10))
    plan = account_facts(moves)._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize(
    "kind, status, amount, fee, interchange, spread, cost",
    [
        ("card_payment", "completed", "100.00", "0.00", "0.65", "0.00", "0.17"),
        ("card_payment", "completed", "10.00", "0.00", "0.07", "0.00", "0.04"),
        ("bank_transfer", "completed", "250.00", "0.00", "0.00", "0.00", "0.04"),
        ("bank_transfer", "completed", "250.01", "0.25", "0.00", "0.00", "0.04"),
        ("fx_exchange", "completed", "100.00", "0.00", "0.00", "0.40", "0.03"),
        ("cash_withdrawal", "completed", "200.00", "0.00", "0.00", "0.00", "0.35"),
        ("cash_withdrawal", "completed", "200.01", "1.00", "0.00", "0.00", "0.35"),
        ("cash_in", "completed", "500.00", "0.00", "0.00", "0.00", "0.02"),
        ("card_payment", "failed", "100.00", "0.00", "0.00", "0.00", "0.01"),
        ("bank_transfer", "reversed", "900.00", "0.00", "0.00", "0.00", "0.01"),
    ],
)
def test_fee_schedule(tx, kind, status, amount, fee, interchange, spread, cost):
    priced = one(economics.with_fees(tx((1, "2026-01-01", kind, status, amount))))
    got = [
        str(priced[c])
        for c in (
            "fee_revenue_gbp",
            "interchange_revenue_gbp",
            "fx_spread_revenue_gbp",
            "processing_cost_gbp",
        )
    ]
    assert got == [fee, interchange, spread, cost]


def test_incentive_goes_to_the_first_funding_only(make, tx):
    moves = tx(
        (11, "2026-01-02", "cash_in", "completed", 10),
        (11, "2026-01-01", "cash_in", "failed", 10),
        (11, "2026-01-01", "card_payment", "completed", 10),
        (11, "2026-01-02", "cash_in", "completed", 10),  # same time, later id
        (12, "2026-01-01", "cash_in", "completed", 10),  # control
    ).drop("incentive_cost_gbp")
    holders = make(
        "accounts", dict(account_id=11, customer_id=1), dict(account_id=12, customer_id=2)
    )
    arms = make(
        "experiment_assignments",
        dict(assignment_id=1, customer_id=1, experiment_name="x", variant="bonus_10"),
        dict(assignment_id=2, customer_id=2, experiment_name="x", variant="control"),
    )
    charged = economics.with_incentive(moves, holders, arms)
    assert rows(charged.where("incentive_cost_gbp > 0"), "transaction_id") == [(1,)]


def test_tenure_is_whole_days_and_at_least_one(make):
    opened = ["2026-08-31 12:00:00", "2026-08-29 23:59:59", "2026-08-30 00:00:00"]
    holders = make(
        "accounts",
        *[dict(account_id=i, customer_id=i, opened_ts=at(o)) for i, o in enumerate(opened)],
    )
    found = rows(economics.tenure(holders, at("2026-08-31 23:59:59")))
    assert found == [(0, 1), (1, 2), (2, 1)]


@pytest.mark.parametrize(
    "total, count, places, expected",
    [("16.33", 8, 4, 2.0413), ("17.33", 8, 4, 2.1663), ("-16.33", 8, 4, -2.0413), ("5.35", 2, 2, 2.68)]
    + [("1.00", 0, 2, None), (None, 3, 2, None)],
)
def test_ratios_round_half_away_from_zero(spark, total, count, places, expected):
    df = spark.createDataFrame([(total and Decimal(total), count)], "t decimal(14,2), n bigint")
    assert df.select(per(df.t, df.n, places)).first()[0] == expected


def test_transaction_keys_stay_apart_at_ten_digits(spark, tmp_path):
    """Order, part and supplier keys far beyond those of the small tables."""
    from datetime import datetime

    from tidemark.plans.binding import Bank

    day, big = datetime(1996, 1, 1), 9_999_999_999
    tables = {
        "customer": ([(1, 0, 10.0, "BUILDING")], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (
            [(big, 1, day, "1-URGENT"), (big - 1, 1, day, "1-URGENT")],
            "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "lineitem": (
            [
                (o, p, s, n, 1000.0, "N", "O", day)
                for o in (big, big - 1)
                for p in (1, big)
                for s in (big, 10)
                for n in (1, 7)
            ],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
            "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (made, schema) in tables.items():
        spark.createDataFrame(made, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    bank = Bank(spark, str(tmp_path))
    ids = [r.transaction_id for r in bank.transactions.collect()]
    assert len(ids) == len(set(ids)) == 16
    charged = bank.transactions_with_incentive.where("incentive_cost_gbp > 0")
    assert charged.count() <= 1
