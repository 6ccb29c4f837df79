"""Named queries over one folder of source tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fees import fee_columns
from tidemark.operators import (
    channels,
    dashboard,
    economics,
    events,
    experiment,
    funnel,
    ledger,
    quality,
    quantiles,
    ratelimit,
    retention,
    running,
    segments,
    settlement,
)
from tidemark.plans.binding import Bank, Ledger
from tidemark.schemas import TABLES
from tidemark.session import run_dir, stored
from tidemark.sources import history, sinks, snapshots, tables
from tidemark.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

SWEEP_AT = datetime(2024, 1, 1, 7, 0, 0)
DAY_SECONDS = 86_400
QUOTA = 20
RETRY_SECONDS = 2 * DAY_SECONDS
# How far the rows of the source files may be out of order: their whole span.
EVENT_DISORDER, ORDER_DISORDER = "40 days", "3000 days"
SETTLED_QUOTA, SETTLED_BALANCE = 600, 60_000


def comparable(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, and decimal keys as text, which both engines print alike."""
    return df.select(
        *[
            F.col(f"`{f.name}`")
            .cast("string" if f.name.endswith("_id") else "double")
            .alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def views(bank: Bank) -> dict[str, Callable[[], DataFrame]]:
    """The seven published views, built on demand."""
    b = bank
    return {
        "kpis": lambda: dashboard.headline_kpis(
            b.customers, b.kyc_cases, b.accounts, b.product_events, b.transactions
        ),
        "channel_performance": lambda: channels.channel_performance(
            b.customers, b.accounts, b.product_events, b.transactions, b.marketing_spend
        ),
        "retention_cohorts": lambda: retention.monthly_cohorts(b.transactions, b.rule),
        "experiment_performance": lambda: experiment.experiment_performance(
            b.experiment_assignments, b.product_events, b.accounts, b.account_economics
        ),
        "fx_customer_segments": lambda: segments.fx_customer_segments(b.transactions),
        "fx_retention": lambda: retention.fx_retention(b.transactions, b.rule),
        "transaction_economics": lambda: economics.transaction_economics(b.transactions),
    }


def bank_queries() -> dict[str, Callable[[Bank], DataFrame]]:
    """Every analytics query over a bank: derived (Bank) or stored (StoredBank) tables."""

    def arms(b: Bank, by=()) -> DataFrame:
        people = b.experiment_assignments.join(
            b.customers.select("customer_id", "acquisition_channel"), "customer_id"
        )
        return experiment.arm_summary(
            people if by else b.experiment_assignments,
            b.product_events,
            b.accounts,
            b.account_economics,
            by,
        )

    def rounded(df: DataFrame) -> DataFrame:
        """Nine significant digits, however small the value: engines agree on exp and sqrt to
        about 15, not to the last bit."""
        return df.select(
            *[
                F.format_string("%.8e", c).cast("double").alias(c)
                if t == "double"
                else F.col(c).alias(c)
                for c, t in df.dtypes
            ]
        )

    by_experiment = ["experiment_name", "acquisition_channel"]
    return {
        "q01_funnel": lambda b: funnel.onboarding_funnel(
            b.customers, b.kyc_cases, b.accounts, b.product_events
        ),
        "q02_funnel_rates": lambda b: funnel.funnel_rates(
            funnel.onboarding_funnel(b.customers, b.kyc_cases, b.accounts, b.product_events)
        ),
        "q03_kyc_by_channel": lambda b: funnel.kyc_by_channel(b.customers, b.kyc_cases),
        "q04_acct_to_funding": lambda b: funnel.account_to_funding(
            b.customers, b.accounts, b.product_events
        ),
        "q05_signup_to_funding": lambda b: funnel.signup_to_funding(b.customers, b.product_events),
        "q06_cac": lambda b: channels.acquisition_cost(b.customers, b.marketing_spend),
        "q07_cost_per_funded": lambda b: channels.cost_per_funded(
            b.customers, b.product_events, b.marketing_spend
        ),
        "q08_d30_by_channel": lambda b: retention.d30_by_channel(
            b.customers, b.accounts, b.transactions, b.rule
        ),
        "q09_avg_volume": lambda b: channels.average_volume(
            b.customers, b.accounts, b.transactions
        ),
        "q10_avg_frequency": lambda b: channels.average_frequency(
            b.customers, b.accounts, b.transactions
        ),
        "q11_revenue_by_type": lambda b: economics.revenue_by_type(b.transactions),
        "q12_margin_by_type": lambda b: economics.margin_by_type(b.transactions),
        "q13_unit_margin": lambda b: economics.unit_margin(b.transactions),
        "q14_fx_vs_non": lambda b: segments.fx_against_rest(b.transactions),
        "q15_fx_retention": lambda b: retention.fx_retention(b.transactions, b.rule).orderBy(
            F.desc("d30_retention_pct"), "customer_segment"
        ),
        "q16_fx_share": lambda b: segments.fx_share_by_channel(
            b.customers, b.accounts, b.transactions
        ),
        "q17_avg_margin_channel": lambda b: channels.average_margin(
            b.customers, b.accounts, b.transactions
        ),
        "q18_total_margin_channel": lambda b: channels.total_margin(
            b.customers, b.accounts, b.transactions
        ),
        "q19_net_contribution": lambda b: channels.net_contribution(
            b.customers, b.accounts, b.transactions, b.marketing_spend
        ),
        "v_channel_performance": lambda b: views(b)["channel_performance"](),
        "v_dashboard_kpis": lambda b: views(b)["kpis"](),
        "v_experiment_performance": lambda b: views(b)["experiment_performance"](),
        "v_fx_customer_segments": lambda b: views(b)["fx_customer_segments"](),
        "v_fx_retention": lambda b: views(b)["fx_retention"](),
        "v_retention_cohorts": lambda b: views(b)["retention_cohorts"](),
        "v_transaction_economics": lambda b: views(b)["transaction_economics"](),
        "exp_summary": lambda b: arms(b),
        "exp_ztest": lambda b: rounded(
            experiment.readout(arms(b)).select(*experiment.TEST_COLUMNS)
        ),
        "exp_economics": lambda b: rounded(
            experiment.readout(arms(b)).select(*experiment.ECONOMICS_COLUMNS)
        ),
        "exp_decision": lambda b: rounded(
            experiment.readout(arms(b)).select("lift", "p_value", *experiment.DECISION_COLUMNS)
        ),
        "exp_by_dim": lambda b: rounded(experiment.readout(arms(b, by_experiment), by_experiment)),
        "ev_lifecycle": lambda b: b.lifecycle_events,
        "ev_first_funding": lambda b: events.first_funding_events(b.accounts, b.transactions),
        "ev_first_transaction": lambda b: events.first_transaction_events(
            b.accounts, b.transactions
        ),
        "ev_refresh": lambda b: events.refreshed_events(
            b.product_events, b.accounts, b.transactions
        ),
        "tx_economics": lambda b: b.transactions.select(
            "transaction_id", "transaction_type", "status", "amount_gbp", *fee_columns()
        ),
        "tx_amount_median": lambda b: quantiles.grouped_median(
            b.transactions.withColumn("day", F.to_date("transaction_ts")),
            ["transaction_type", "day"],
            F.col("amount_gbp"),
            "median_amount_gbp",
        ),
        "tx_incentive": lambda b: b.transactions_with_incentive.where(
            "incentive_cost_gbp > 0"
        ).select("transaction_id", "account_id", "transaction_ts", "incentive_cost_gbp"),
        "tx_cards": lambda b: b.card_transactions,
        "tx_transfers": lambda b: b.transfers,
        "fx_quote": lambda b: b.fx_transactions,
        "tx_subtypes": lambda b: economics.subtype_coverage(b.transactions, b.details),
        "acct_tenure": lambda b: economics.tenure(b.accounts, b.rule.as_of),
        "val_row_counts": lambda b: quality.row_counts(
            {
                name: b.tables()[name]
                for name in (
                    "customers",
                    "kyc_cases",
                    "accounts",
                    "marketing_spend",
                    "experiment_assignments",
                    "product_events",
                )
            }
        ),
        "val_kyc_status": lambda b: quality.frequency(b.kyc_cases, "status", "customers"),
        "val_events": lambda b: quality.frequency(b.product_events, "event_name", "events"),
        "val_signups": lambda b: quality.frequency(b.customers, "acquisition_channel", "signups"),
        "val_variants": lambda b: quality.frequency(
            b.experiment_assignments, "variant", "assigned_customers", by_count=False
        ),
        "dq_unique": lambda b: quality.check_unique(b.stored().tables()),
        "dq_not_null": lambda b: quality.check_not_null(b.stored().tables()),
        "dq_domain": lambda b: quality.check_domains(b.stored().tables(), b.domains),
        "dq_range": lambda b: quality.check_ranges(b.stored().tables()),
        "dq_fk": lambda b: quality.check_foreign_keys(b.stored().tables()),
        "dq_contract": lambda b: quality.check_contracts(
            {name: view() for name, view in views(b.stored()).items()}
        ),
        "dash_headline": lambda b: dashboard.headline(views(b)["kpis"]()),
        "dash_channels": lambda b: dashboard.channel_table(views(b)["channel_performance"]()),
        "dash_channels_by_conversion": lambda b: dashboard.channels_by_conversion(
            views(b)["channel_performance"]()
        ),
        "dash_channels_by_cost": lambda b: dashboard.channels_by_cost(
            views(b)["channel_performance"]()
        ),
        "dash_retention_long": lambda b: dashboard.retention_long(
            views(b)["retention_cohorts"]()
        ),
        "dash_variant_labels": lambda b: dashboard.labelled_variants(
            views(b)["experiment_performance"]()
        ).select(
            "variant", "variant_label", "activation_rate_pct", "avg_margin_after_incentive_gbp"
        ),
        "dash_fx_delta": lambda b: dashboard.fx_deltas(
            views(b)["fx_customer_segments"](), views(b)["fx_retention"]()
        ),
        "dash_economics": lambda b: dashboard.economics_table(
            views(b)["transaction_economics"]()
        ),
        "dash_economics_by_margin": lambda b: dashboard.economics_by_margin(
            views(b)["transaction_economics"]()
        ),
    }


def _storage_queries() -> dict[str, Callable[[Bank], DataFrame]]:
    return {
        "src_csv": _csv_roundtrip,
        "src_columns": _column_subset,
        "src_extracts": lambda b: _extracts(b)["channel_performance"],
        "sink_extracts": lambda b: quality.row_counts(_extracts(b)),
        "sink_views": _named_view,
        "sink_publish": _publish_roundtrip,
        "sink_refresh": _partition_refresh,
        "dq_defaults": _defaults,
    }


def _csv_roundtrip(b: Bank) -> DataFrame:
    """Write the customers as CSV into the shared folder and read them back typed."""
    folder = run_dir(b.spark, "csv")
    sinks.write_csv_tables({"customers": b.customers, "kyc_cases": b.kyc_cases}, folder)
    loaded = tables.read_csv_tables(b.spark, folder, ["customers", "kyc_cases"])
    return loaded["customers"].join(loaded["kyc_cases"], "customer_id")


def _column_subset(b: Bank) -> DataFrame:
    """Two columns of a wider CSV file."""
    path = f"{run_dir(b.spark, 'columns')}/customers.csv"
    sinks.write_csv(b.customers, path)
    return tables.read_csv(b.spark, path, TABLES["customers"].schema, ["customer_id", "age"])


def _extracts(b: Bank) -> dict[str, DataFrame]:
    """Every published view written as an extract and read back."""
    folder = run_dir(b.spark, "extracts")
    sinks.write_extracts({name: view() for name, view in views(b.stored()).items()}, folder)
    return tables.read_extracts(b.spark, folder)


def _named_view(b: Bank) -> DataFrame:
    """A view registered by name, reached in SQL."""
    sinks.register_views({"transaction_economics": views(b)["transaction_economics"]()})
    return b.spark.sql("SELECT * FROM vw_transaction_economics")


def _defaults(b: Bank) -> DataFrame:
    """All transactions as a feed leaves them, with amounts only where one is due, and the declared defaults."""
    amounts = ["fee_revenue_gbp", "interchange_revenue_gbp", "fx_spread_revenue_gbp", "processing_cost_gbp"]
    due = {c: F.nullif(F.col(c), F.lit(0).cast("decimal(12,2)")) for c in amounts}
    feed = b.transactions.withColumns(due).drop("incentive_cost_gbp")
    return quality.fill_defaults(feed, "transactions").select("transaction_id", *amounts, "incentive_cost_gbp")


def _publish_roundtrip(b: Bank) -> DataFrame:
    """Publish a table set twice; readers see the second one only."""
    folder = run_dir(b.spark, "published")
    sinks.publish(b.spark, {"accounts": b.accounts.where("plan_tier = 'premium'")}, folder)
    sinks.publish(b.spark, {"accounts": b.accounts}, folder)
    return sinks.published(b.spark, folder)["accounts"]


def _partition_refresh(b: Bank) -> DataFrame:
    """Events stored by kind and year; the kinds that follow from transactions are refreshed in place."""
    keys = {"kind": F.col("event_name"), "year": F.date_format("event_ts", "yyyy")}
    store = snapshots.Snapshots(b.spark, run_dir(b.spark, "snapshots"), keys)
    b = b.stored()
    log = stored(b.product_events, "log")
    stale = (F.col("event_name") == "first_transaction") & (F.col("customer_id") % 2 == 0)
    store.refresh(log.where(~stale))
    fresh = stored(events.transaction_events(b.accounts, b.transactions).select(*log.columns), "fresh")
    store.refresh(fresh, F.col("kind").isin(*events.TRANSACTION_EVENTS))
    return store.read()


def _ledger_queries() -> dict[str, Callable[[Ledger], DataFrame]]:
    def sweep(g: Ledger) -> DataFrame:
        parts = {
            "sessions": g.user_sessions,
            "accounts": g.user_accounts,
            "transfers": g.transfers,
        }
        left = ledger.swept(g.user_sessions, g.user_accounts, g.transfers, SWEEP_AT)
        return quality.row_counts(parts).join(
            quality.row_counts(left).withColumnRenamed("row_count", "kept"), "table_name"
        )

    def ledger_tables(g: Ledger) -> dict[str, DataFrame]:
        return {
            "ledger_sessions": g.user_sessions,
            "ledger_accounts": g.owned_accounts,
            "ledger_transfers": g.transfers.select(*TABLES["ledger_transfers"].columns),
        }

    def ring_page(g: Ledger) -> DataFrame:
        return ledger.account_history(g.series, tables.series_account(42))

    def second_page(g: Ledger) -> DataFrame:
        """The page after the first five rows of an account, from stored history."""
        path = run_dir(g.spark, "history")
        history.write(ledger.postings(g.series), path)
        pages, account = history.History(g.spark, path), tables.series_account(42)
        first = pages.page(account, 5).collect()
        before = (first[-1].created_at, first[-1].transfer_id) if first else None
        return pages.page(account, 5, before)

    return {
        "ledger_history_keyset": second_page,
        "ledger_validate": lambda g: ledger.validated_transfers(g.raw_requests).drop("body"),
        "ledger_validate_accounts": lambda g: ledger.validated_accounts(
            g.raw_account_requests
        ).drop("body"),
        "ledger_idempotency": lambda g: ledger.classified_requests(
            g.valid_requests, g.journal
        ).select("request_id", "session_id", "idempotency_key", "amount_minor", "outcome"),
        "ledger_outcomes": lambda g: ledger.outcomes(
            g.raw_requests, g.group_sessions, g.accounts, QUOTA
        ),
        "ledger_settlement": lambda g: settlement.settlement(
            g.raw_requests, g.group_sessions, g.accounts, SETTLED_QUOTA, SETTLED_BALANCE
        ),
        "ledger_journal": lambda g: g.journal,
        "ledger_postings": lambda g: g.postings,
        "ledger_balances": lambda g: ledger.balances(g.accounts, g.postings),
        "ledger_conservation": lambda g: ledger.conservation(g.accounts, g.postings),
        "ledger_running": lambda g: running.running_balances(g.accounts, g.postings),
        "ledger_overdrafts": lambda g: running.overdraft_summary(
            running.running_balances(g.accounts, g.postings)
        ),
        "ledger_quota_accounts": lambda g: ledger.account_quota(
            g.accounts.select("account_id", "session_id", "created_at")
        ),
        "ledger_quota_transfers": lambda g: ledger.transfer_quota(
            g.journal.select("request_id", "session_id", "created_at")
        ),
        "ledger_history": lambda g: ledger.history_pages(g.postings, 20, 5),
        "ledger_history_deep": lambda g: ledger.history_pages(g.postings, 100, 50),
        "ledger_rate_limit": lambda g: ratelimit.rate_limited(
            g.user_requests, g.long_sessions, limit=3, window_seconds=DAY_SECONDS
        ),
        "ledger_session_expiry": sweep,
        "ledger_admission": lambda g: ledger.admission(g.user_sessions, SWEEP_AT, 25, 3),
        "ledger_admission_timeline": lambda g: ledger.admission_timeline(
            g.user_sessions, "1 hour", "10 minutes", 20, 5
        ),
        "ledger_visibility": lambda g: ledger.visible_reads(g.reads, g.user_accounts),
        "bench_transfers": ring_page,
        "dq_cross": lambda g: quality.check_differs(ledger_tables(g)),
        "dq_ledger": lambda g: quality.check_unique(ledger_tables(g))
        .unionByName(quality.check_not_null(ledger_tables(g)))
        .unionByName(quality.check_domains(ledger_tables(g)))
        .unionByName(quality.check_ranges(ledger_tables(g)))
        .unionByName(quality.check_foreign_keys(ledger_tables(g))),
    }


def _stream_queries() -> dict[str, Query]:
    """Each runs over everything available in the source files and returns what it wrote."""

    def requests(spark: SparkSession, folder: str) -> Ledger:
        return Ledger(spark, folder, jobs.file_stream(spark, f"{folder}/events.parquet"))

    def lines(spark: SparkSession, folder: str) -> Bank:
        """Lineitems as a stream; the orders they meet are written once, not per micro-batch."""
        bank = Bank(spark, folder, jobs.file_stream(spark, f"{folder}/lineitem.parquet"))
        staged = f"{run_dir(spark, 'orders')}/bought"
        bank.bought.write.parquet(staged)
        bank.bought = spark.read.parquet(staged)
        return bank

    def staged(sessions: DataFrame) -> DataFrame:
        """Sessions written once and streamed as they were created."""
        path = run_dir(sessions.sparkSession, "sessions")
        sessions.select("session_id", "created_at", "expires_at").write.parquet(path)
        return jobs.file_stream(sessions.sparkSession, path)

    def unique(spark: SparkSession, folder: str) -> DataFrame:
        valid = requests(spark, folder).valid_requests
        return jobs.unique_requests(valid, RETRY_SECONDS, EVENT_DISORDER).drop("late")

    def limited(spark: SparkSession, folder: str) -> DataFrame:
        sessions = staged(Ledger(spark, folder).long_sessions)
        found = requests(spark, folder).user_requests
        return jobs.rate_limited(found, sessions, 3, DAY_SECONDS, EVENT_DISORDER).drop("late")

    def expired(spark: SparkSession, folder: str) -> DataFrame:
        sessions = staged(Ledger(spark, folder).user_sessions)
        return jobs.expired_sessions(requests(spark, folder).user_requests, sessions, EVENT_DISORDER)

    def counts(spark: SparkSession, folder: str) -> DataFrame:
        return jobs.request_counts(requests(spark, folder).user_requests)

    def daily(spark: SparkSession, folder: str) -> DataFrame:
        return jobs.daily_economics(lines(spark, folder).transactions)

    def fundings(spark: SparkSession, folder: str) -> DataFrame:
        return jobs.first_fundings(lines(spark, folder).transactions)

    def cohort(spark: SparkSession, folder: str) -> DataFrame:
        """Fundings are derived and written once, then both sides are streamed."""
        bank, staged = Bank(spark, folder), f"{run_dir(spark, 'cohort')}/fundings"
        economics.first_fundings(bank.transactions).write.parquet(staged)
        window = bank.rule.windows[0]
        return jobs.activity_after_funding(
            jobs.file_stream(spark, staged),
            lines(spark, folder).transactions,
            window.first,
            window.end,
            ORDER_DISORDER,
        )

    return {
        "stream_unique_requests": unique,
        "stream_rate_limit": limited,
        "stream_session_expiry": expired,
        "stream_request_counts": counts,
        "stream_daily_economics": daily,
        "stream_first_funding": fundings,
        "stream_cohort_activity": cohort,
    }


def named_queries() -> dict[str, Query]:
    def over(source, build) -> Query:
        return lambda spark, folder: comparable(build(source(spark, folder)))

    found = {name: over(Bank, build) for name, build in bank_queries().items()}
    found |= {name: over(Bank, build) for name, build in _storage_queries().items()}
    found |= {name: over(Ledger, build) for name, build in _ledger_queries().items()}
    found |= {
        name: lambda spark, folder, run=run: comparable(run(spark, folder))
        for name, run in _stream_queries().items()
    }
    return found
