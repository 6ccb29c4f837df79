"""A/B readout: the published figures, and random pairs of arms against plain arithmetic."""

import math
import random

import pytest

from tests.conftest import rows
from tidemark.operators import experiment

# Published arms (assigned, activated, incentive cost, average margin).
PUBLISHED = [
    ("published", "bonus_10", 25_081, 18_340, 183_400.0, 2.48),
    ("published", "control", 24_919, 17_202, 0.0, 2.47),
]
ARMS = (
    "pair string, variant string, assigned_customers bigint, activated_customers bigint, "
    "total_incentive_cost_gbp double, avg_margin_before_incentive_gbp double"
)


def random_arms(n: int):
    random.seed(11)
    arms = []
    for i in range(n):
        for variant, cost in (("bonus_10", random.uniform(0, 500)), ("control", 0.0)):
            total = random.randint(20, 3_000)
            hits = random.randint(1, total - 1)
            arms.append((f"p{i}", variant, total, hits, cost, random.uniform(-1, 5)))
    return arms


def swapped(arms):
    other = {"bonus_10": "control", "control": "bonus_10"}
    return [(pair + "-swapped", other[v], *rest) for pair, v, *rest in arms]


@pytest.fixture(scope="module")
def arms():
    even = [("even", v, 1_000, 500, 10.0, 1.0) for v in ("bonus_10", "control")]
    cheap = [("cheap", "bonus_10", 1_000, 600, 50.0, 3.0), ("cheap", "control", 1_000, 500, 0.0, 3.0)]
    drawn = random_arms(60)
    return PUBLISHED + even + cheap + drawn + swapped(drawn) + swapped(PUBLISHED)


@pytest.fixture(scope="module")
def results(spark, arms):
    """All pairs are read out by one query."""
    found = experiment.readout(spark.createDataFrame(arms, ARMS), by=["pair"])
    return {row["pair"]: row.asDict() for row in found.collect()}


def test_published_figures(results):
    r = results["published"]
    assert r["lift"] * 100 == pytest.approx(4.0914, abs=1e-4)
    assert r["z_stat"] == pytest.approx(10.0895, abs=1e-4)
    assert r["p_value"] == pytest.approx(6.145e-24, rel=0.01)
    assert (r["ci_lower"] * 100, r["ci_upper"] * 100) == pytest.approx((3.30, 4.89), abs=0.01)
    assert r["relative_lift"] * 100 == pytest.approx(5.93, abs=0.01)
    assert r["incremental_activations"] == pytest.approx(1026.17, abs=0.01)
    assert r["break_even_margin_gbp"] == pytest.approx(178.72, abs=0.01)
    assert (r["significant"], r["launch"]) == (True, False)


def test_every_pair_against_arithmetic(arms, results):
    sides = {}
    for pair, variant, *figures in arms:
        sides.setdefault(pair, {})[variant] = figures
    for pair, arm in sides.items():
        (n, hits, cost, _), (m, base, _, margin) = arm["bonus_10"], arm["control"]
        r, lift = results[pair], hits / n - base / m
        share = (hits + base) / (n + m)
        z = lift / math.sqrt(share * (1 - share) * (1 / n + 1 / m))
        assert r["z_stat"] == pytest.approx(z, abs=1e-9), pair
        assert r["p_value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-6), pair
        assert (r["ci_lower"] + r["ci_upper"]) / 2 == pytest.approx(lift), pair
        due = cost / (lift * n) if lift > 0 else math.inf
        assert r["break_even_margin_gbp"] == pytest.approx(due), pair
        assert r["launch"] == (margin >= due), pair
        assert r["significant"] == (lift > 0 and r["p_value"] < 0.05), pair


def test_direction_only_changes_the_sign(results):
    for pair in [p for p in results if p + "-swapped" in results]:
        there, back = results[pair], results[pair + "-swapped"]
        assert back["z_stat"] == pytest.approx(-there["z_stat"])
        assert back["p_value"] == pytest.approx(there["p_value"])


def test_no_effect_never_pays_back(results):
    r = results["even"]
    assert (r["z_stat"], r["payback_pct"], r["launch"]) == (0, 0, False)
    assert r["break_even_margin_gbp"] == math.inf
    assert results["cheap"]["launch"]


@pytest.fixture(scope="module")
def trial(make, tx):
    arms = [(1, "bonus_10"), (2, "bonus_10"), (3, "control"), (4, "control")]
    assignments = make(
        "experiment_assignments",
        *[
            dict(assignment_id=c, customer_id=c, experiment_name="x", variant=v)
            for c, v in arms
        ],
    )
    log = make(
        "product_events",
        *[
            dict(event_id=i, customer_id=c, event_name="first_funding")
            for i, c in enumerate([1, 1, 3, 4])
        ],
    )
    holders = make("accounts", *[dict(account_id=c * 10, customer_id=c) for c in (1, 3, 4)])
    paid = dict(fee_revenue_gbp="3.00", incentive_cost_gbp="10.00")
    moves = tx(
        (10, "2026-01-01", "cash_in", "completed", 9, paid),
        (30, "2026-01-01", "cash_in", "completed", 9, dict(fee_revenue_gbp="2.00")),
        # Account 40 has no transaction: its NULL margin is left out of the average.
    )
    return assignments, log, holders, moves


def test_performance(trial):
    found = rows(experiment.experiment_performance(*trial))
    assert [tuple(map(str, r)) for r in found] == [
        ("bonus_10", "2", "1", "50.0", "10.00", "3.0", "-7.0"),
        ("control", "2", "2", "100.0", "0.00", "2.0", "2.0"),
    ]


def test_summary_defaults_missing_margin_to_zero(trial):
    assignments, log, holders, moves = trial
    found = rows(
        experiment.arm_summary(assignments, log, holders, moves.limit(0)),
        "variant",
        "total_incentive_cost_gbp",
        "avg_margin_before_incentive_gbp",
    )
    assert [(v, float(c), m) for v, c, m in found] == [
        ("bonus_10", 0.0, 0.0),
        ("control", 0.0, 0.0),
    ]
