"""Typed tables, their keys and their constraints.

Spark keeps types but enforces no keys or checks, so constraints are declared here as data and
evaluated by :mod:`tidemark.operators.quality`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The domains of the coded columns.
CHANNELS = ("organic", "paid_search", "paid_social", "referral", "affiliate")
DEVICES = ("iOS", "Android")
KYC_STATUSES = ("approved", "rejected", "abandoned")
PLAN_TIERS = ("standard", "premium")
BASE_CURRENCIES = ("GBP", "EUR")
VARIANTS = ("control", "bonus_10")
TRANSACTION_TYPES = (
    "cash_in",
    "card_payment",
    "bank_transfer",
    "fx_exchange",
    "cash_withdrawal",
)
STATUSES = ("completed", "failed", "reversed")
DIRECTIONS = ("inbound", "outbound")
RAILS = ("faster_payments", "sepa", "swift")
MAX_OPENING_MINOR = 1_000_000_000_000
MAX_TRANSFER_MINOR = 1_000_000_000_000
MAX_BALANCE_MINOR = 9_000_000_000_000_000


@dataclass(frozen=True)
class Table:
    """A table: DDL of its columns plus the rules its rows must satisfy."""

    name: str
    ddl: str
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    nullable: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[int | None, int | None]] = field(default_factory=dict)
    lengths: dict[str, tuple[int, int]] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    differs: tuple[tuple[str, str], ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        plain = T.StructType.fromDDL(self.ddl)
        return T.StructType(
            [T.StructField(f.name, f.dataType, f.name in self.nullable) for f in plain]
        )

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [c for c in self.columns if c not in self.nullable]


ZERO = "0.00"

ANALYTICS = [
    Table(
        "customers",
        "customer_id bigint, signup_ts timestamp_ntz, country_code string, age smallint, "
        "acquisition_channel string, device_os string, referral_code_used boolean",
        key=("customer_id",),
        domains={"acquisition_channel": CHANNELS, "device_os": DEVICES},
        ranges={"age": (18, 100)},
        defaults={"referral_code_used": False},
    ),
    Table(
        "kyc_cases",
        "kyc_case_id bigint, customer_id bigint, started_ts timestamp_ntz, "
        "completed_ts timestamp_ntz, status string, failure_reason string",
        key=("kyc_case_id",),
        nullable=("started_ts", "completed_ts", "failure_reason"),
        domains={"status": KYC_STATUSES},
        parents={"customer_id": ("customers", "customer_id")},
    ),
    Table(
        "accounts",
        "account_id bigint, customer_id bigint, opened_ts timestamp_ntz, plan_tier string, "
        "base_currency string",
        key=("account_id",),
        unique=(("customer_id",),),
        domains={"plan_tier": PLAN_TIERS, "base_currency": BASE_CURRENCIES},
        parents={"customer_id": ("customers", "customer_id")},
    ),
    Table(
        "marketing_spend",
        "spend_month date, acquisition_channel string, spend_gbp decimal(14,2), "
        "impressions bigint, clicks bigint",
        key=("spend_month", "acquisition_channel"),
        ranges={"spend_gbp": (0, None), "impressions": (0, None), "clicks": (0, None)},
    ),
    Table(
        "experiment_assignments",
        "assignment_id bigint, customer_id bigint, experiment_name string, variant string, "
        "assigned_ts timestamp_ntz",
        key=("assignment_id",),
        unique=(("customer_id", "experiment_name"),),
        domains={"variant": VARIANTS},
        parents={"customer_id": ("customers", "customer_id")},
    ),
    Table(
        "product_events",
        "event_id bigint, customer_id bigint, event_ts timestamp_ntz, event_name string, "
        "session_id string, event_value decimal(14,2)",
        key=("event_id",),
        nullable=("session_id", "event_value"),
        parents={"customer_id": ("customers", "customer_id")},
    ),
    Table(
        "transactions",
        "transaction_id decimal(38,0), account_id bigint, transaction_ts timestamp_ntz, "
        "transaction_type string, status string, amount_gbp decimal(14,2), "
        "fee_revenue_gbp decimal(12,2), interchange_revenue_gbp decimal(12,2), "
        "fx_spread_revenue_gbp decimal(12,2), processing_cost_gbp decimal(12,2), "
        "incentive_cost_gbp decimal(12,2)",
        key=("transaction_id",),
        domains={"transaction_type": TRANSACTION_TYPES, "status": STATUSES},
        ranges={"amount_gbp": (0, None)},
        parents={"account_id": ("accounts", "account_id")},
        defaults={
            "fee_revenue_gbp": ZERO,
            "interchange_revenue_gbp": ZERO,
            "fx_spread_revenue_gbp": ZERO,
            "processing_cost_gbp": ZERO,
            "incentive_cost_gbp": ZERO,
        },
    ),
    Table(
        "card_transactions",
        "transaction_id decimal(38,0), merchant_category string, merchant_country string, "
        "card_present boolean",
        key=("transaction_id",),
        nullable=("merchant_category", "merchant_country", "card_present"),
        parents={"transaction_id": ("transactions", "transaction_id")},
    ),
    Table(
        "transfers",
        "transaction_id decimal(38,0), direction string, transfer_rail string, "
        "counterparty_country string",
        key=("transaction_id",),
        nullable=("counterparty_country",),
        domains={"direction": DIRECTIONS, "transfer_rail": RAILS},
        parents={"transaction_id": ("transactions", "transaction_id")},
    ),
    Table(
        "fx_transactions",
        "transaction_id decimal(38,0), from_currency string, to_currency string, "
        "source_amount decimal(14,2), target_amount decimal(14,2), quoted_rate decimal(18,8), "
        "spread_bps decimal(10,2)",
        key=("transaction_id",),
        parents={"transaction_id": ("transactions", "transaction_id")},
    ),
]

LEDGER = [
    Table(
        "ledger_sessions",
        "session_id string, token_hash string, created_at timestamp_ntz, "
        "expires_at timestamp_ntz, window_start timestamp_ntz, request_count int",
        key=("session_id",),
        unique=(("token_hash",),),
        defaults={"request_count": 0},
    ),
    Table(
        "ledger_accounts",
        "account_id string, owner_name string, currency string, opening_balance_minor bigint, "
        "balance_minor bigint, created_at timestamp_ntz, session_id string",
        key=("account_id",),
        nullable=("session_id",),
        domains={"currency": ("GBP",)},
        ranges={
            "opening_balance_minor": (0, MAX_OPENING_MINOR),
            "balance_minor": (0, MAX_BALANCE_MINOR),
        },
        lengths={"owner_name": (1, 100)},
        parents={"session_id": ("ledger_sessions", "session_id")},
        defaults={"currency": "GBP"},
    ),
    Table(
        "ledger_transfers",
        "transfer_id string, idempotency_key string, source_account_id string, "
        "destination_account_id string, amount_minor bigint, currency string, "
        "created_at timestamp_ntz",
        key=("transfer_id",),
        unique=(("idempotency_key",),),
        domains={"currency": ("GBP",)},
        ranges={"amount_minor": (1, MAX_TRANSFER_MINOR)},
        lengths={"idempotency_key": (1, 128)},
        parents={
            "source_account_id": ("ledger_accounts", "account_id"),
            "destination_account_id": ("ledger_accounts", "account_id"),
        },
        differs=(("source_account_id", "destination_account_id"),),
        defaults={"currency": "GBP"},
    ),
]

TABLES = {t.name: t for t in ANALYTICS + LEDGER}

# The seven published extracts, in publication column order.
EXTRACTS = {
    "kpis": "total_signups bigint, kyc_approved bigint, accounts_opened bigint, "
    "funded_customers bigint, transacting_customers bigint, total_transactions bigint, "
    "completed_transaction_volume_gbp decimal(24,2), total_contribution_margin_gbp decimal(24,2)",
    "channel_performance": "acquisition_channel string, signups bigint, funded_customers bigint, "
    "signup_to_funding_pct double, acquisition_spend_gbp decimal(24,2), cac_gbp double, "
    "cost_per_funded_customer_gbp double, avg_transaction_volume_gbp double, "
    "avg_contribution_margin_gbp double",
    "retention_cohorts": "funding_cohort date, funded_customers bigint, retained_d30 bigint, "
    "d30_retention_pct double, retained_d60 bigint, d60_retention_pct double",
    "experiment_performance": "variant string, assigned_customers bigint, "
    "activated_customers bigint, activation_rate_pct double, "
    "total_incentive_cost_gbp decimal(24,2), avg_margin_before_incentive_gbp double, "
    "avg_margin_after_incentive_gbp double",
    "fx_customer_segments": "customer_segment string, customers bigint, "
    "avg_completed_transactions double, avg_transaction_volume_gbp double, "
    "avg_contribution_margin_gbp double",
    "fx_retention": "customer_segment string, eligible_customers bigint, retained_d30 bigint, "
    "d30_retention_pct double",
    "transaction_economics": "transaction_type string, completed_transactions bigint, "
    "transaction_volume_gbp decimal(24,2), revenue_gbp decimal(24,2), "
    "processing_cost_gbp decimal(24,2), contribution_margin_gbp decimal(24,2), "
    "avg_margin_per_transaction_gbp double",
}
