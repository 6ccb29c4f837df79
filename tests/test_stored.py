"""Queries over tables loaded from CSV equal those over the derived tables."""

import pytest

from tests.conftest import SMALL, rows
from tidemark.plans.binding import RULE, Bank
from tidemark.plans.registry import bank_queries, comparable, named_queries
from tidemark.plans.stored import StoredBank
from tidemark.sources import sinks, tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bank"))
    sinks.write_csv_tables(Bank(spark, SMALL).tables(), path)
    return path


@pytest.fixture(scope="module")
def stored(spark, folder):
    bank = StoredBank.from_csv(spark, folder, RULE)
    bank.domains = Bank.domains
    return bank


SAMPLE = [n for n in bank_queries() if n.startswith(("v_", "exp_", "tx_"))]


@pytest.mark.parametrize("name", SAMPLE)
def test_same_results(spark, stored, name):
    derived = named_queries()[name](spark, SMALL)
    assert rows(comparable(stored.query(name)), *derived.columns) == rows(derived)


def test_extracts_and_views(spark, stored, tmp_path):
    stored.write_extracts(str(tmp_path))
    loaded = tables.read_extracts(spark, str(tmp_path))
    assert rows(loaded["kpis"]) == rows(stored.query("v_dashboard_kpis"))
    assert len(stored.register_views()) == 7
    assert spark.table("vw_transaction_economics").count() == 5


def test_missing_tables_are_named(spark):
    with pytest.raises(ValueError, match="kyc_cases"):
        StoredBank({"customers": spark.range(1)})
