"""Constraint checks find exactly the rows that break them."""

import pytest

from tests.conftest import at, one, rows
from tidemark.operators import quality


def violations(checks):
    return {c: n for c, n in rows(checks, "check_name", "violations") if n}


@pytest.fixture(scope="module")
def people(make):
    good = dict(
        signup_ts=at("2026-01-01"),
        country_code="GB",
        age=30,
        acquisition_channel="organic",
        device_os="iOS",
    )
    return make(
        "customers",
        good | dict(customer_id=1),
        good | dict(customer_id=1, age=17),
        good | dict(customer_id=2, age=101, acquisition_channel="radio"),
        good | dict(customer_id=3, device_os=None),
    )


def test_unique(people):
    assert violations(quality.check_unique({"customers": people})) == {"unique:customer_id": 1}


def test_unique_on_several_columns(make):
    arm = dict(experiment_name="x", variant="control", assigned_ts=at("2026-01-01"))
    arms = make(
        "experiment_assignments",
        arm | dict(assignment_id=1, customer_id=1),
        arm | dict(assignment_id=2, customer_id=1),
        arm | dict(assignment_id=3, customer_id=1, experiment_name="y"),
    )
    found = violations(quality.check_unique({"experiment_assignments": arms}))
    assert found == {"unique:customer_id,experiment_name": 1}


def test_not_null(people):
    assert violations(quality.check_not_null({"customers": people})) == {"not_null:device_os": 1}


def test_domain_ignores_null(people):
    found = violations(quality.check_domains({"customers": people}))
    assert found == {"domain:acquisition_channel": 1}
    wider = {"acquisition_channel": ["organic", "radio"]}
    assert violations(quality.check_domains({"customers": people}, wider)) == {}


def test_range(people):
    assert violations(quality.check_ranges({"customers": people})) == {"range:age": 2}


def test_orphans_count_rows_of_missing_parents(make, people):
    holders = make(
        "accounts",
        *[dict(account_id=i, customer_id=c) for i, c in enumerate([1, 2, 9, 9, None])],
    )
    tables = {"accounts": holders, "customers": people}
    found = violations(quality.check_foreign_keys(tables))
    assert found == {"foreign_key:customer_id": 2}


def test_ledger_rules(make):
    transfer = dict(
        source_account_id="a", destination_account_id="b", amount_minor=1, created_at=at("2026-01-01")
    )
    transfers = make(
        "ledger_transfers",
        transfer | dict(transfer_id="1", idempotency_key="k"),
        transfer | dict(transfer_id="2", idempotency_key="k", destination_account_id="a"),
        transfer | dict(transfer_id="3", idempotency_key="", amount_minor=0),
        transfer | dict(transfer_id="4", idempotency_key="x" * 129, amount_minor=10**12 + 1),
    )
    tables = {"ledger_transfers": transfers}
    assert violations(quality.check_unique(tables)) == {"unique:idempotency_key": 1}
    assert violations(quality.check_differs(tables)) == {
        "differs:source_account_id,destination_account_id": 1
    }
    assert violations(quality.check_ranges(tables)) == {
        "range:amount_minor": 2,
        "length:idempotency_key": 2,
    }


def test_defaults(spark, make):
    bare = spark.createDataFrame([(1, None)], "transaction_id bigint, fee_revenue_gbp decimal(12,2)")
    filled = one(quality.fill_defaults(bare, "transactions"))
    assert str(filled["fee_revenue_gbp"]) == "0.00"
    assert str(filled["incentive_cost_gbp"]) == "0.00"
    people = spark.createDataFrame([(1,)], "customer_id bigint")
    assert one(quality.fill_defaults(people, "customers"))["referral_code_used"] is False


def test_validation_queries(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "status string")
    assert [tuple(r) for r in quality.frequency(df, "status", "n").collect()] == [
        ("b", 2),
        ("a", 1),
    ]
    by_name = quality.frequency(df, "status", "n", by_count=False).collect()
    assert [r.status for r in by_name] == ["a", "b"]
    counted = quality.row_counts({"z": df, "a": df.limit(0)}).collect()
    assert [tuple(r) for r in counted] == [("a", 0), ("z", 3)]
