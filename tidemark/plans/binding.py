"""The bank's tables derived from a star schema plus an event stream.

Every rule is deterministic and set-based, so the tables grow with their sources: customers,
accounts and transactions come from customer, orders and lineitem; the ledger comes from events.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fees import RATES_TO_GBP
from tidemark.functions.money import MONEY
from tidemark.functions.text import zero_padded
from tidemark.operators import economics, events, experiment, ledger
from tidemark.operators.retention import RetentionRule, Window
from tidemark.session import run_dir, stored
from tidemark.sources.tables import transfer_series

ACCOUNT_OFFSET = 1_000_000  # account_id is never a customer_id, so a join on the wrong key shows
SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")
TYPE_BY_PRIORITY = {
    "1": "cash_in",
    "2": "card_payment",
    "3": "bank_transfer",
    "4": "fx_exchange",
    "5": "cash_withdrawal",
}
EXPERIMENT = "welcome_bonus"
KEY_SLOT = 10**11  # part and supplier keys take eleven digits of a transaction_id
RULE = RetentionRule(
    windows=(Window("d30", 180, 360), Window("d60", 360, 540)),
    min_events=2,
    as_of=datetime(2001, 11, 5),
)
OPENING_MINOR = 30_000
USERS_PER_SESSION = 50


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    """One of a few literals by 0-based position."""
    case = F
    for i, value in enumerate(values):
        case = case.when(index == i, F.lit(value))
    return case.otherwise(F.lit(None).cast("string"))


def _line_number() -> Column:
    """A lineitem's four keys side by side; order keys have room for fifteen digits."""
    order, part, supplier = (
        F.col(c).cast(f"decimal({n},0)")
        for c, n in (("l_orderkey", 15), ("l_partkey", 11), ("l_suppkey", 11))
    )
    slot = F.lit(KEY_SLOT).cast("decimal(12,0)")
    line = (order * 10 + F.col("l_linenumber")).cast("decimal(16,0)")
    return (((line * slot + part).cast("decimal(27,0)")) * slot + supplier).cast("decimal(38,0)")


class Bank:
    """Analytics tables over one folder of parquet files; nothing is read until used.

    ``lineitem`` may be replaced, for example by a stream of the same rows.
    """

    rule = RULE
    domains = {"acquisition_channel": SEGMENTS}

    def __init__(self, spark: SparkSession, folder: str, lineitem: DataFrame | None = None):
        self.spark, self.folder, self.lineitem = spark, folder, lineitem

    def source(self, name: str) -> DataFrame:
        if name == "lineitem" and self.lineitem is not None:
            return self.lineitem
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _people(self) -> DataFrame:
        """Customers with their signup: the first order, or a fixed day without one."""
        first = (
            self.source("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.min("o_orderdate").alias("_first"))
        )
        signup = F.coalesce("_first", _ntz("1995-01-01 00:00:00"))
        return (
            self.source("customer")
            .join(first, "c_custkey", "left")
            .withColumn("signup_ts", signup)
            .drop("_first")
        )

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._people.select(
            key.alias("customer_id"),
            "signup_ts",
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country_code"),
            (18 + key % 60).cast("smallint").alias("age"),
            F.lower("c_mktsegment").alias("acquisition_channel"),
            F.when(key % 2 == 0, "iOS").otherwise("Android").alias("device_os"),
            (key % 25 == 0).alias("referral_code_used"),
        )

    @cached_property
    def kyc_cases(self) -> DataFrame:
        key, balance = F.col("c_custkey"), F.col("c_acctbal")
        status = (
            F.when(balance >= 0, "approved").when(balance < -500, "rejected").otherwise("abandoned")
        )
        started = F.col("signup_ts") + F.expr("INTERVAL 1 HOUR")
        known = self._people.withColumn("status", status)
        ended = F.col("status") != "abandoned"
        return known.select(
            key.alias("kyc_case_id"),
            key.alias("customer_id"),
            F.when(ended | (key % 2 == 0), started).alias("started_ts"),
            F.when(ended, started + F.expr("INTERVAL 12 HOURS")).alias("completed_ts"),
            "status",
            F.when(F.col("status") == "rejected", "refused")
            .when(F.col("status") == "abandoned", "not_finished")
            .alias("failure_reason"),
        )

    @property
    def _currency(self) -> Column:
        return F.when(F.col("c_nationkey") % 2 == 0, "GBP").otherwise("EUR")

    @cached_property
    def accounts(self) -> DataFrame:
        return self._people.where("c_acctbal >= 0").select(
            (F.col("c_custkey") + ACCOUNT_OFFSET).alias("account_id"),
            F.col("c_custkey").alias("customer_id"),
            (F.col("signup_ts") + F.expr("INTERVAL 1 DAY")).alias("opened_ts"),
            F.when(F.col("c_acctbal") >= 5000, "premium").otherwise("standard").alias("plan_tier"),
            self._currency.alias("base_currency"),
        )

    @cached_property
    def marketing_spend(self) -> DataFrame:
        signups = F.count("*")
        return self.customers.groupBy(
            F.trunc("signup_ts", "MM").alias("spend_month"), "acquisition_channel"
        ).agg(
            (signups * F.lit(25)).cast(MONEY).alias("spend_gbp"),
            (signups * 1000).alias("impressions"),
            (signups * 40).alias("clicks"),
        )

    @cached_property
    def experiment_assignments(self) -> DataFrame:
        return self.customers.select(
            F.col("customer_id").alias("assignment_id"),
            "customer_id",
            F.lit(EXPERIMENT).alias("experiment_name"),
            F.when(F.col("customer_id") % 3 == 0, "bonus_10").otherwise("control").alias("variant"),
            F.col("signup_ts").alias("assigned_ts"),
        )

    @cached_property
    def bought(self) -> DataFrame:
        """Orders of account holders, narrowed before they meet the far larger lineitem."""
        holders = self.source("customer").where("c_acctbal >= 0").select("c_custkey")
        kind = F.substring("o_orderpriority", 1, 1)
        return (
            self.source("orders")
            .join(holders, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
            .select(
                "o_orderkey",
                (F.col("o_custkey") + ACCOUNT_OFFSET).alias("account_id"),
                _typed(kind).alias("transaction_type"),
            )
        )

    @cached_property
    def _movements(self) -> DataFrame:
        """Lineitems of account holders, typed but not yet priced."""
        returned, open_line = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
        status = F.when(~returned, "completed").when(open_line, "reversed").otherwise("failed")
        hundredth = F.lit("0.01").cast("decimal(3,2)")
        amount = F.round(F.col("l_extendedprice").cast(MONEY) * hundredth, 2).cast(MONEY)
        return (
            self.source("lineitem")
            .join(self.bought, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                _line_number().alias("transaction_id"),
                "account_id",
                F.col("l_shipdate").alias("transaction_ts"),
                "transaction_type",
                status.alias("status"),
                amount.alias("amount_gbp"),
                "l_partkey",
                "l_suppkey",
                "l_linenumber",
            )
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """Priced transactions, before the activation bonus is charged."""
        return economics.with_fees(
            self._movements.select(
                "transaction_id",
                "account_id",
                "transaction_ts",
                "transaction_type",
                "status",
                "amount_gbp",
            )
        )

    @cached_property
    def transactions_with_incentive(self) -> DataFrame:
        return economics.with_incentive(
            self.transactions, self.accounts, self.experiment_assignments
        )

    @cached_property
    def account_economics(self) -> DataFrame:
        """Margin and bonus per account, without attaching the bonus to a transaction."""
        return experiment.charged_facts(
            self.transactions, self.accounts, self.experiment_assignments
        )

    def stored(self) -> Bank:
        """The same bank with its movements written once, for checks that read them often."""
        path = f"{run_dir(self.spark, 'movements')}/movements"
        self._movements.write.parquet(path)
        again = Bank(self.spark, self.folder)
        again._movements = self.spark.read.parquet(path)
        return again

    @cached_property
    def detailed_transactions(self) -> DataFrame:
        """Transactions with the attributes their subtype tables need."""
        part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
        currencies = tuple(RATES_TO_GBP)
        others = {
            base: _pick(tuple(c for c in currencies if c != base), supplier % 3)
            for base in ("GBP", "EUR")
        }
        target = F.when(F.col("base_currency") == "GBP", others["GBP"]).otherwise(others["EUR"])
        currencies_held = self.source("customer").select(
            (F.col("c_custkey") + ACCOUNT_OFFSET).alias("account_id"),
            self._currency.alias("base_currency"),
        )
        return self._movements.join(currencies_held, "account_id").select(
            "transaction_id",
            "account_id",
            "transaction_type",
            "amount_gbp",
            "base_currency",
            F.concat(F.lit("M"), (part % 6).cast("string")).alias("merchant_category"),
            F.concat(F.lit("N"), (supplier % 25).cast("string")).alias("merchant_country"),
            (line <= 5).alias("card_present"),
            F.when(part % 5 < 2, "inbound").otherwise("outbound").alias("direction"),
            (line == 7).alias("is_swift"),
            F.concat(F.lit("N"), (part % 25).cast("string")).alias("counterparty_country"),
            target.alias("target_currency"),
        )

    @cached_property
    def card_transactions(self) -> DataFrame:
        return economics.card_details(self.detailed_transactions)

    @cached_property
    def transfers(self) -> DataFrame:
        return economics.transfer_details(self.detailed_transactions)

    @cached_property
    def fx_transactions(self) -> DataFrame:
        return economics.fx_details(self.detailed_transactions)

    @cached_property
    def details(self) -> dict[str, DataFrame]:
        return {
            "card_payment": self.card_transactions,
            "bank_transfer": self.transfers,
            "fx_exchange": self.fx_transactions,
        }

    @cached_property
    def lifecycle_events(self) -> DataFrame:
        """Four kinds of events; the customers they all start from are joined once and written.

        Spark puts the parts of a union that are partitioned alike into the same tasks, which would then hold the
        sorts and hash maps of four joins at a time.
        """
        columns = ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", "signup_ts"]
        met = Bank(self.spark, self.folder)
        met._people = stored(self._people.select(*columns), "people")
        return events.lifecycle_events(met.customers, met.kyc_cases, met.accounts)

    @cached_property
    def product_events(self) -> DataFrame:
        return self.lifecycle_events.unionByName(
            events.transaction_events(self.accounts, self.transactions)
        )

    def tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "kyc_cases": self.kyc_cases,
            "accounts": self.accounts,
            "marketing_spend": self.marketing_spend,
            "experiment_assignments": self.experiment_assignments,
            "product_events": self.product_events,
            "transactions": self.transactions_with_incentive,
            "card_transactions": self.card_transactions,
            "transfers": self.transfers,
            "fx_transactions": self.fx_transactions,
        }


def _typed(digit: Column) -> Column:
    case = F
    for priority, name in TYPE_BY_PRIORITY.items():
        case = case.when(digit == priority, F.lit(name))
    return case.otherwise(F.lit(None).cast("string"))


class Ledger:
    """Requests, accounts, sessions and transfers derived from the event stream.

    With ``events`` given as a stream, the request properties are streams too.
    """

    def __init__(self, spark: SparkSession, folder: str, events: DataFrame | None = None):
        self.spark, self.folder = spark, folder
        self.events = (
            spark.read.parquet(f"{folder}/events.parquet") if events is None else events
        )

    @cached_property
    def _events(self) -> DataFrame:
        """Events with ``k`` out of their JSON.

        Filters on columns made from ``k`` would be pushed below the parsing and repeat it once
        per mention. They cannot pass a generator, so exploding a single value parses it once.
        """
        k = F.get_json_object("props", "$.k").cast("bigint")
        parsed = F.explode(F.array(k)).alias("k")
        return self.events.select("event_id", "ts", "user_id", "event_type", parsed)

    @staticmethod
    def _account(user: Column) -> Column:
        """A UUID-shaped account id per user."""
        return F.concat(F.lit("00000000-0000-4000-8000-"), zero_padded(user, 12))

    @staticmethod
    def _session(user: Column) -> Column:
        return F.floor(user / USERS_PER_SESSION).cast("string")

    @cached_property
    def typed_requests(self) -> DataFrame:
        """One transfer request per event; some break a rule."""
        user, k = F.col("user_id"), F.col("k")
        payee = F.when(k == 50, user).otherwise(user + 1 + k % 3)
        error = F.when(F.col("event_type") == "error", 1).otherwise(0)
        return self._events.select(
            F.col("event_id").alias("request_id"),
            self._session(user).alias("session_id"),
            F.concat_ws(":", user.cast("string"), k.cast("string")).alias("idempotency_key"),
            self._account(user).alias("source_account_id"),
            self._account(payee).alias("destination_account_id"),
            (k * 100 + error).alias("amount_minor"),
            F.lit("GBP").alias("currency"),
            "ts",
        )

    @cached_property
    def valid_requests(self) -> DataFrame:
        return self.typed_requests.where(
            F.col("amount_minor").between(1, ledger.MAX_TRANSFER_MINOR)
            & (F.col("source_account_id") != F.col("destination_account_id"))
        )

    @cached_property
    def raw_requests(self) -> DataFrame:
        """The same requests as JSON bodies, with a different fault in some residue classes."""
        fault = F.col("request_id") % 23
        amount = F.col("amount_minor").cast("string")
        shown = (
            F.when(fault == 0, F.concat(F.lit('"'), amount, F.lit('"')))
            .when(fault == 1, F.concat(amount, F.lit(".5")))
            .when(fault == 2, "true")
            .when(fault == 3, "-1")
            .when(fault == 4, "1000000000001")
            .when(fault == 5, F.concat(amount, F.lit(', "admin": true')))
            .when(fault == 6, "null")
            .when(fault == 7, F.concat(amount, F.lit(".0")))
            .otherwise(amount)
        )
        currency = (
            F.when(fault == 8, ', "currency": "USD"')
            .when(fault == 9, "")
            .when(fault == 10, ', "currency": null')
            .otherwise(', "currency": "GBP"')
        )
        source = (
            F.when(fault == 11, "not-a-uuid")
            .when(fault == 12, F.upper(F.replace("source_account_id", F.lit("-"), F.lit(""))))
            .otherwise(F.col("source_account_id"))
        )
        body = F.concat(
            F.lit('{"source_account_id": "'),
            source,
            F.lit('", "destination_account_id": "'),
            F.col("destination_account_id"),
            F.lit('", "amount_minor": '),
            shown,
            currency,
            F.when(fault == 13, "").otherwise("}"),
        )
        key = (
            F.when(fault == 14, " ")
            .when(fault == 15, F.repeat(F.lit("k"), 129))
            .otherwise(F.col("idempotency_key"))
        )
        return self.typed_requests.select(
            "request_id", "session_id", key.alias("idempotency_key"), body.alias("body"), "ts"
        )

    @cached_property
    def raw_account_requests(self) -> DataFrame:
        """Account creations as JSON bodies: one per event, with faults as above."""
        fault, name = F.col("event_id") % 11, F.col("event_type")
        opening = F.col("k") * 100
        body = (
            F.when(fault == 0, '{"owner_name": "  "}')
            .when(fault == 1, '{"owner_name": "A", "opening_balance_minor": -1}')
            .when(fault == 2, '{"owner_name": "A", "opening_balance_minor": 0.5}')
            .when(fault == 3, '{"owner_name": "A", "currency": "USD"}')
            .when(fault == 4, '{"owner_name": "A", "admin": true}')
            .when(fault == 5, '[]')
            .when(fault == 6, F.concat(F.lit('{"owner_name": "  '), name, F.lit(' "}')))
            .otherwise(
                F.concat(
                    F.lit('{"owner_name": "'),
                    name,
                    F.lit('", "opening_balance_minor": '),
                    opening.cast("string"),
                    F.lit("}"),
                )
            )
        )
        return self._events.select(
            F.col("event_id").alias("request_id"),
            self._session(F.col("user_id")).alias("session_id"),
            body.alias("body"),
            "ts",
        )

    @cached_property
    def _users(self) -> DataFrame:
        return self._events.groupBy("user_id").agg(F.min("ts").alias("created_at"))

    @cached_property
    def accounts(self) -> DataFrame:
        """One account per user; the stored balance is that of the opening day."""
        user = F.col("user_id")
        return self._users.select(
            self._account(user).alias("account_id"),
            F.concat(F.lit("User "), user.cast("string")).alias("owner_name"),
            F.lit("GBP").alias("currency"),
            F.lit(OPENING_MINOR).cast("bigint").alias("opening_balance_minor"),
            F.lit(OPENING_MINOR).cast("bigint").alias("balance_minor"),
            "created_at",
            self._session(user).alias("session_id"),
        )

    @cached_property
    def user_sessions(self) -> DataFrame:
        """One session per user, opened by its first event."""
        user = F.col("user_id").cast("string")
        return self._users.select(
            user.alias("session_id"),
            F.sha2(user, 256).alias("token_hash"),
            "created_at",
            (F.col("created_at") + F.expr("INTERVAL 30 MINUTES")).alias("expires_at"),
            F.col("created_at").alias("window_start"),
            F.lit(0).alias("request_count"),
        )

    @cached_property
    def long_sessions(self) -> DataFrame:
        """The same sessions, alive for ten days."""
        ends = F.col("created_at") + F.expr("INTERVAL 10 DAYS")
        return self.user_sessions.withColumn("expires_at", ends)

    @cached_property
    def group_sessions(self) -> DataFrame:
        """Sessions shared by several users, alive for twenty days; one in seven is unknown."""
        group = F.floor(F.col("user_id") / USERS_PER_SESSION)
        opened = self._users.groupBy(group.alias("_group")).agg(F.min("created_at").alias("created_at"))
        return opened.where(F.col("_group") % 7 != 3).select(
            F.col("_group").cast("string").alias("session_id"),
            "created_at",
            (F.col("created_at") + F.expr("INTERVAL 20 DAYS")).alias("expires_at"),
        )

    @cached_property
    def user_accounts(self) -> DataFrame:
        """Accounts owned by the user's own session; every tenth user has no session."""
        user = F.col("user_id")
        return self._users.select(
            self._account(user).alias("account_id"),
            F.when(user % 10 != 0, user.cast("string")).alias("session_id"),
        )

    @cached_property
    def owned_accounts(self) -> DataFrame:
        """The full account rows, each in its user's own session."""
        owners = self.user_accounts.select("account_id", "session_id")
        return self.accounts.drop("session_id").join(owners, "account_id")

    @cached_property
    def user_requests(self) -> DataFrame:
        return self._events.select(
            F.col("event_id").alias("request_id"),
            F.col("user_id").cast("string").alias("session_id"),
            "ts",
            (F.col("event_type") == "signup").alias("opens_session"),
        )

    @cached_property
    def reads(self) -> DataFrame:
        """Account reads: each event reads the account of its own or of a later user."""
        user = F.col("user_id")
        return self._events.select(
            F.col("event_id").alias("request_id"),
            F.when(user % 10 != 0, user.cast("string")).alias("session_id"),
            self._account(user + F.col("k") % 2 * 10).alias("account_id"),
        )

    @cached_property
    def journal(self) -> DataFrame:
        return ledger.journal(self.valid_requests, self.accounts)

    @cached_property
    def transfers(self) -> DataFrame:
        return self.journal.withColumn("transfer_id", zero_padded(F.col("request_id"), 12))

    @cached_property
    def postings(self) -> DataFrame:
        return ledger.postings(self.transfers)

    @cached_property
    def series(self) -> DataFrame:
        """The ring of transfers, one per event."""
        return transfer_series(self._events, "event_id")
