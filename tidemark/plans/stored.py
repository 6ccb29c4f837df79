"""The same queries over tables a user already has."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import events
from tidemark.operators.accounts import account_facts
from tidemark.operators.retention import RetentionRule
from tidemark.plans.registry import bank_queries, views
from tidemark.schemas import ANALYTICS
from tidemark.sources import sinks
from tidemark.sources.tables import read_csv_tables, read_parquet_tables

NAMES = [t.name for t in ANALYTICS]


class StoredBank:
    """Stored analytics tables, reachable by name as attributes."""

    domains: Mapping[str, tuple[str, ...]] = {}

    def __init__(self, tables: Mapping[str, DataFrame], rule: RetentionRule = RetentionRule()):
        missing = [name for name in NAMES if name not in tables]
        if missing:
            raise ValueError(f"missing tables: {', '.join(missing)}")
        self._tables, self.rule = dict(tables), rule

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str, rule: RetentionRule = RetentionRule()):
        return cls(read_csv_tables(spark, folder, NAMES), rule)

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, rule: RetentionRule = RetentionRule()):
        return cls(read_parquet_tables(spark, folder, NAMES), rule)

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["_tables"][name]
        except KeyError:
            raise AttributeError(name) from None

    def tables(self) -> dict[str, DataFrame]:
        return {name: self._tables[name] for name in NAMES}

    @property
    def transactions_with_incentive(self) -> DataFrame:
        """Stored transactions already carry their incentive cost."""
        return self.transactions

    @property
    def account_economics(self) -> DataFrame:
        return account_facts(self.transactions).select(
            "account_id", "margin_gbp", "incentive_gbp"
        )

    def stored(self) -> StoredBank:
        return self

    @property
    def lifecycle_events(self) -> DataFrame:
        return events.lifecycle_events(self.customers, self.kyc_cases, self.accounts)

    @property
    def details(self) -> dict[str, DataFrame]:
        return {
            "card_payment": self.card_transactions,
            "bank_transfer": self.transfers,
            "fx_exchange": self.fx_transactions,
        }

    def query(self, name: str) -> DataFrame:
        """Any analytics query by name, with exact decimals."""
        return bank_queries()[name](self)

    def views(self) -> dict[str, DataFrame]:
        built: dict[str, Callable[[], DataFrame]] = views(self)
        return {name: build() for name, build in built.items()}

    def register_views(self) -> list[str]:
        return sinks.register_views(self.views())

    def write_extracts(self, folder: str) -> None:
        sinks.write_extracts(self.views(), folder)
