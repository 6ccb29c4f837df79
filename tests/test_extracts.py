"""Published figures: contracts hold, ratios recompute, dashboard transforms show them."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import extracts
from tests.conftest import one, rows
from tidemark.functions.money import pct, per
from tidemark.operators import dashboard, quality
from tidemark.schemas import EXTRACTS
from tidemark.sources import sinks, tables


@pytest.fixture(scope="module")
def published(spark):
    found = {}
    for name, data in extracts.ALL.items():
        schema = T.StructType.fromDDL(EXTRACTS[name])
        money = [isinstance(f.dataType, T.DecimalType) for f in schema]
        typed = [tuple(Decimal(v) if m else v for v, m in zip(row, money)) for row in data]
        found[name] = spark.createDataFrame(typed, schema)
    return found


def failed(checks):
    return [c[0] for c in rows(checks.where(~F.col("passed")), "check_name")]


def test_published_extracts_meet_every_contract(published):
    checks = quality.check_contracts(published)
    assert checks.count() == 23 and failed(checks) == []


@pytest.mark.parametrize(
    "view, column, value, broken",
    [
        ("kpis", "funded_customers", 35543, ["funded_reconcile", "segments_partition_funded"]),
        ("kpis", "accounts_opened", 1, ["approved_equals_accounts"]),
        ("kpis", "transacting_customers", 35553, ["funnel_monotone"]),
        ("channel_performance", "signup_to_funding_pct", 1.0, ["conversion_recomputes"]),
        ("channel_performance", "cost_per_funded_customer_gbp", 1.0, ["cost_recomputes"]),
        ("retention_cohorts", "d60_retention_pct", 101.0, ["rates_are_percentages"]),
        ("retention_cohorts", "d30_retention_pct", 50.0, ["rate_recomputes"]),
        ("experiment_performance", "variant", "other", None),
    ],
)
def test_a_wrong_figure_breaks_its_contract(published, view, column, value, broken):
    old = published[view]
    literal = F.lit(value).cast(old.schema[column].dataType)
    found = failed(quality.check_contracts(published | {view: old.withColumn(column, literal)}))
    if broken is None:
        assert "arms_are_known" in found
    else:
        assert found == broken


def test_an_empty_extract_fails(published):
    empty = published | {"fx_retention": published["fx_retention"].limit(0)}
    assert failed(quality.check_contracts(empty)) == ["non_empty"]


def test_ratios_recompute(published):
    channels = published["channel_performance"]
    wrong = channels.where(
        (pct(F.col("funded_customers"), F.col("signups")) != F.col("signup_to_funding_pct"))
        | (per(F.col("acquisition_spend_gbp"), F.col("signups")) != F.col("cac_gbp"))
    )
    assert wrong.count() == 0
    unit = per(F.col("contribution_margin_gbp"), F.col("completed_transactions"), 4)
    economics = published["transaction_economics"]
    assert economics.where(unit != F.col("avg_margin_per_transaction_gbp")).count() == 0


def test_headline(published):
    assert one(dashboard.headline(published["kpis"])) == dict(
        signups="50,000",
        funded_customers="35,542",
        transactions="891,772",
        completed_volume="£49.8M",
        signup_to_funding="71.1%",
        kyc_approved="42,276",
        transacting_customers="35,536",
        contribution_margin="£88,059",
    )


def test_channel_views(published):
    performance = published["channel_performance"]
    by_rate = [r.channel for r in dashboard.channels_by_conversion(performance).collect()]
    assert by_rate == ["Referral", "Organic", "Paid Search", "Affiliate", "Paid Social"]
    by_cost = [r.channel for r in dashboard.channels_by_cost(performance).collect()]
    assert by_cost == ["Organic", "Referral", "Paid Search", "Affiliate", "Paid Social"]
    assert dashboard.channel_table(performance).columns == list(
        dashboard.CHANNEL_CAPTIONS.values()
    )


def test_retention_long(published):
    long = dashboard.retention_long(published["retention_cohorts"])
    assert long.count() == 10
    assert one(long.where("cohort = 'Jan 2026' and metric = 'D60'"))["retention_pct"] == 77.16


def test_fx_deltas(published):
    assert one(
        dashboard.fx_deltas(published["fx_customer_segments"], published["fx_retention"])
    ) == dict(
        completed_transactions_delta=12.41,
        transaction_volume_delta_gbp=771.45,
        d30_retention_delta_pp=18.36,
    )


def test_labels(published):
    labels = rows(
        dashboard.labelled_variants(published["experiment_performance"]), "variant_label"
    )
    assert labels == [("Control",), ("£10 bonus",)]
    shown = dashboard.economics_by_margin(published["transaction_economics"]).collect()
    assert [r.transaction_label for r in shown] == [
        "Card Payment",
        "Fx Exchange",
        "Cash In",
        "Bank Transfer",
        "Cash Withdrawal",
    ]
    table = dashboard.economics_table(published["transaction_economics"])
    assert table.columns == list(dashboard.ECONOMICS_CAPTIONS.values())


def test_extracts_round_trip(spark, published, tmp_path):
    sinks.write_extracts(published, str(tmp_path))
    for name, df in tables.read_extracts(spark, str(tmp_path)).items():
        assert rows(df) == rows(published[name]), name


def test_views_are_queryable(spark, published):
    names = sinks.register_views(published)
    assert "vw_kpis" in names
    assert spark.sql("SELECT total_signups FROM vw_kpis").first()[0] == 50_000
