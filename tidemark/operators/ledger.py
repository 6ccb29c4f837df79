"""Transfer-ledger rules as set-based jobs over request logs and journals."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scan import into_ranges, prefix_sums
from tidemark.operators.skew import first_per_key, mark_first, ranked
from tidemark.schemas import MAX_BALANCE_MINOR, MAX_OPENING_MINOR, MAX_TRANSFER_MINOR
from tidemark.session import stored

# Fixed values of the request rules.
KEY_PATTERN = r"\A[A-Za-z0-9._:-]+\z"
KEY_LENGTH = 128
NAME_LENGTH = 100
UUID_CANONICAL = r"\A[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"
UUID_PATTERN = (
    r"\A(?:urn:uuid:)?(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|\{[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\})\z"
)
EXACT = "decimal(38,0)"  # sums of minor units outgrow 64 bits
TRANSFER_FIELDS = ["source_account_id", "destination_account_id", "amount_minor", "currency"]
ACCOUNT_FIELDS = ["owner_name", "currency", "opening_balance_minor"]
ACCOUNTS_PER_SESSION = 5
TRANSFERS_PER_SESSION = 100
SESSION_LIFETIME = timedelta(minutes=30)
SESSIONS_ALIVE = 200
SESSIONS_PER_MINUTE = 20
PAGE_LIMIT, PAGE_OFFSET = 100, 10_000


# ---- request validation ------------------------------------------------------------------


def _parsed(requests: DataFrame, fields: list[str]) -> DataFrame:
    """Read each body once as VARIANT, which still tells 100 from "100", 1.0 and true.

    Adds per field its kind (NULL when absent, VOID for a JSON null) and its text or integer
    value, plus whether the body is an object and whether it has other fields. Every step is a
    projection of its own, so the body is parsed once however often its parts are used. Of a repeated
    field the last value counts, as usual JSON readers have it.
    """
    requests.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    doc = F.col("_doc")
    part = {f: F.variant_get(doc, f"$.{f}", "variant") for f in fields}
    known = reduce(lambda n, f: n + _given(f).cast("int"), fields, F.lit(0))
    return (
        requests.withColumn("_doc", F.try_parse_json("body"))
        .withColumn("_fields", F.nullif(F.size(F.try_variant_get(doc, "$", "map<string,variant>")), F.lit(-1)))
        .withColumn("_is_object", F.col("_fields").isNotNull())
        .withColumns({f"_{f}_kind": F.schema_of_variant(part[f]) for f in fields})
        .withColumns(
            {
                f"_{f}": F.when(
                    F.col(f"_{f}_kind").isin("STRING", "BIGINT"),
                    F.try_variant_get(doc, f"$.{f}", "string"),
                )
                for f in fields
            }
        )
        .withColumn(
            "_has_unknown",
            F.coalesce(F.col("_fields") > known, F.lit(False)),
        )
    )


def _text(field: str) -> Column:
    return F.when(F.col(f"_{field}_kind") == "STRING", F.col(f"_{field}"))


def _integer(field: str) -> Column:
    return F.when(F.col(f"_{field}_kind") == "BIGINT", F.col(f"_{field}")).cast("bigint")


def _given(field: str) -> Column:
    return F.col(f"_{field}_kind").isNotNull()


def _without_parts(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def _first_reason(rules: list[tuple[str, Column]]) -> Column:
    case = reduce(lambda c, rule: c.when(rule[1], F.lit(rule[0])), rules, F)
    return case.otherwise(F.lit(None).cast("string"))


def _canonical_uuid(text: Column) -> Column:
    """Lower-case hyphenated form of any accepted spelling, NULL for anything else."""
    digits = F.regexp_replace(text, r"\Aurn:uuid:|[{}-]", "")
    hyphenated = F.regexp_replace(digits, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    return F.when(F.rlike(text, F.lit(UUID_CANONICAL)), text).when(
        F.rlike(text, F.lit(UUID_PATTERN)), F.lower(hyphenated)
    )


def _bad_currency() -> Column:
    """Absent means GBP; anything else must be exactly that text."""
    return _given("currency") & ~F.coalesce(_text("currency") == "GBP", F.lit(False))


def _not_between(value: Column, low: int, high: int) -> Column:
    return ~F.coalesce(value.between(low, high), F.lit(False))


def validated_transfers(requests: DataFrame) -> DataFrame:
    """Parse transfer requests; ``reason`` is NULL for the valid ones, else the first rule broken."""
    key = F.col("idempotency_key")
    good_key = F.length(key).between(1, KEY_LENGTH) & F.rlike(key, F.lit(KEY_PATTERN))
    source, destination = F.col("source_account_id"), F.col("destination_account_id")
    reason = _first_reason(
        [
            ("idempotency_key", ~F.coalesce(good_key, F.lit(False))),
            ("malformed_body", ~F.col("_is_object")),
            ("unknown_field", F.col("_has_unknown")),
            ("source_account_id", source.isNull()),
            ("destination_account_id", destination.isNull()),
            ("amount_minor", _not_between(F.col("amount_minor"), 1, MAX_TRANSFER_MINOR)),
            ("currency", _bad_currency()),
            ("same_account", source == destination),
        ]
    )
    typed = _parsed(requests, TRANSFER_FIELDS).withColumns(
        {
            "source_account_id": _canonical_uuid(_text("source_account_id")),
            "destination_account_id": _canonical_uuid(_text("destination_account_id")),
            "amount_minor": _integer("amount_minor"),
        }
    )
    return _with_currency(_without_parts(typed.withColumn("reason", reason)))


def validated_accounts(requests: DataFrame) -> DataFrame:
    """Parse account requests; names are trimmed, balance defaults to 0 and currency to GBP."""
    name, opening = F.col("owner_name"), F.col("opening_balance_minor")
    reason = _first_reason(
        [
            ("malformed_body", ~F.col("_is_object")),
            ("unknown_field", F.col("_has_unknown")),
            ("owner_name", _not_between(F.length(name), 1, NAME_LENGTH)),
            ("currency", _bad_currency()),
            ("opening_balance_minor", _not_between(opening, 0, MAX_OPENING_MINOR)),
        ]
    )
    zero = F.lit(0).cast("bigint")
    typed = _parsed(requests, ACCOUNT_FIELDS).withColumns(
        {
            "owner_name": F.regexp_replace(_text("owner_name"), r"(?U)\A\s+|\s+\z", ""),
            "opening_balance_minor": F.when(
                _given("opening_balance_minor"), _integer("opening_balance_minor")
            ).otherwise(zero),
        }
    )
    return _with_currency(_without_parts(typed.withColumn("reason", reason)))


def _with_currency(validated: DataFrame) -> DataFrame:
    return validated.withColumn("currency", F.when(F.col("reason").isNull(), F.lit("GBP")))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their reason)."""
    return (
        validated.where(F.col("reason").isNull()).drop("reason"),
        validated.where(F.col("reason").isNotNull()),
    )


# ---- idempotent transfers ------------------------------------------------------------------


def scoped_key(session: str = "session_id", key: str = "idempotency_key") -> Column:
    """Keys belong to a session; without a session they are global."""
    scoped = F.sha2(F.concat_ws(":", F.col(session), F.col(key)), 256)
    return F.when(F.col(session).isNull(), F.col(key)).otherwise(scoped)


def journal(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Committed transfers: per scoped key the first valid request between two accounts of its
    own session. Balances and quotas are separate audits.
    """
    owner = accounts.select("account_id", F.col("session_id").alias("_owner"))

    def own(df: DataFrame, side: str) -> DataFrame:
        found = owner.withColumnRenamed("account_id", side)
        same = F.col("session_id").eqNullSafe(F.col("_owner"))
        return df.join(found, side).where(same).drop("_owner")

    allowed = own(own(requests, "source_account_id"), "destination_account_id")
    attempts = allowed.select(
        "session_id",
        "idempotency_key",
        "request_id",
        "source_account_id",
        "destination_account_id",
        "amount_minor",
        "currency",
        F.col("ts").alias("created_at"),
    )
    # Group by the short raw key; only the booked rows are hashed.
    booked = first_per_key(
        attempts, ["session_id", "idempotency_key"], ["created_at", "request_id"], "request_id"
    )
    return booked.withColumn("idempotency_key", scoped_key())


def classified_requests(requests: DataFrame, committed: DataFrame) -> DataFrame:
    """Outcome of each valid request against the journal.

    ``committed`` for the request that was booked, ``replayed`` for a later identical one,
    ``conflict`` for a later different one, ``rejected`` otherwise: an attempt before the booking,
    or one whose key was never booked, reserved nothing.
    """
    booked = committed.select(
        F.col("idempotency_key").alias("_key"),
        F.struct("created_at", "request_id").alias("_at"),
        F.struct(*TRANSFER_FIELDS).alias("_fields"),
    )
    at = F.struct(F.col("ts").alias("created_at"), "request_id")
    outcome = (
        F.when(F.col("_at").isNull() | (at < F.col("_at")), "rejected")
        .when(at == F.col("_at"), "committed")
        .when(F.struct(*TRANSFER_FIELDS) == F.col("_fields"), "replayed")
        .otherwise("conflict")
    )
    keyed = requests.withColumn("_key", scoped_key())
    return (
        keyed.join(booked, "_key", "left")
        .withColumn("outcome", outcome)
        .drop("_key", "_at", "_fields")
    )


def checked_requests(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Validated raw requests, with ``_live`` for those whose session was open.

    The parsed requests are written once: they are read twice, and a filter on their columns would be
    pushed below the parsing and repeat it.
    """
    parsed = stored(validated_transfers(requests).drop("body"), "parsed")
    ends = sessions.select("session_id", F.col("expires_at").alias("_ends"))
    live = F.coalesce(F.col("ts") < F.col("_ends"), F.lit(False))
    return parsed.join(ends, "session_id", "left").withColumn("_live", live).drop("_ends")


def outcomes(
    requests: DataFrame,
    sessions: DataFrame,
    accounts: DataFrame,
    limit: int = TRANSFERS_PER_SESSION,
) -> DataFrame:
    """Status of each raw transfer request, and the validation rule a 422 breaks.

    In the order a service decides: 401 without a live session, 422 for a broken rule, 200 or 409 for a
    booked key with the same or other fields, 429 once the session has ``limit`` transfers, 404 unless
    both accounts are the session's own, else 201. Refusals that need live balances are left to the
    running-balance audit. Only the first ``limit`` bookings of a session stand, and the quota never
    frees again, so every later request that is no replay or conflict is a 429.

    ``settlement`` decides those refusals too.
    """
    checked = checked_requests(requests, sessions)
    live = F.col("_live")
    order = ["created_at", "request_id"]
    first = journal(checked.where(live & F.col("reason").isNull()), accounts)
    at = F.struct(F.col("ts").alias("created_at"), "request_id")
    stands = ranked(first, ["session_id"], [F.col(c) for c in order], limit, "request_id")
    booked = stands.select(
        F.col("idempotency_key").alias("_key"),
        F.struct(*order).alias("_at"),
        F.struct(*TRANSFER_FIELDS).alias("_fields"),
    )
    full = stands.where(F.col("rank") == limit).select(
        "session_id", F.struct(*order).alias("_full")
    )
    status = (
        F.when(~live, 401)
        .when(F.col("reason").isNotNull(), 422)
        .when(at == F.col("_at"), 201)
        .when((at > F.col("_at")) & (F.struct(*TRANSFER_FIELDS) == F.col("_fields")), 200)
        .when(at > F.col("_at"), 409)
        .when(at > F.col("_full"), 429)
        .otherwise(404)
    )
    return (
        checked.withColumn("_key", scoped_key())
        .join(booked, "_key", "left")
        .join(full, "session_id", "left")
        .select(
            "request_id",
            "session_id",
            status.alias("status_code"),
            F.when(status == 422, F.col("reason")).alias("reason"),
        )
    )


# ---- postings and balances -----------------------------------------------------------------


def postings(transfers: DataFrame, *carry: str) -> DataFrame:
    """Two signed rows per transfer: out of the source, into the destination."""
    legs = F.array(
        F.struct(
            F.col("source_account_id").alias("account_id"),
            (-F.col("amount_minor")).alias("signed_minor"),
            F.lit("outgoing").alias("direction"),
        ),
        F.struct(
            F.col("destination_account_id").alias("account_id"),
            F.col("amount_minor").alias("signed_minor"),
            F.lit("incoming").alias("direction"),
        ),
    )
    return transfers.select("transfer_id", "created_at", *carry, F.inline(legs))


def balances(accounts: DataFrame, posted: DataFrame) -> DataFrame:
    """Opening plus postings against the stored balance; ``drift_minor`` is 0 when they agree."""
    total = F.sum(F.col("signed_minor").cast(EXACT))
    moved = posted.groupBy("account_id").agg(total.alias("_moved"))
    balance = (F.col("opening_balance_minor") + F.coalesce("_moved", F.lit(0))).cast(EXACT)
    return (
        accounts.join(moved, "account_id", "left")
        .withColumn("computed_balance_minor", balance)
        .select(
            "account_id",
            "opening_balance_minor",
            "computed_balance_minor",
            "balance_minor",
            (F.col("balance_minor") - F.col("computed_balance_minor"))
            .cast(EXACT)
            .alias("drift_minor"),
        )
    )


def conservation(accounts: DataFrame, posted: DataFrame) -> DataFrame:
    """Transfers between known accounts move money but neither make nor lose any."""
    return (
        balances(accounts, posted)
        .agg(
            F.sum(F.col("opening_balance_minor").cast(EXACT)).alias("opening_minor"),
            F.sum("computed_balance_minor").alias("computed_minor"),
        )
        .withColumn("conserved", F.col("opening_minor") == F.col("computed_minor"))
    )


# ---- history -------------------------------------------------------------------------------


def history_pages(posted: DataFrame, limit: int = 20, offset: int = 0) -> DataFrame:
    """One newest-first page for every account at once."""
    if not (1 <= limit <= PAGE_LIMIT and 0 <= offset <= PAGE_OFFSET):
        raise ValueError(f"limit must be 1-{PAGE_LIMIT} and offset 0-{PAGE_OFFSET}")
    newest = [F.desc("created_at"), F.desc("transfer_id")]
    first = ranked(posted, ["account_id"], newest, offset + limit, "transfer_id", rank="position")
    return first.where(F.col("position") > offset)


def account_history(
    transfers: DataFrame, account_id, limit: int = 20, offset: int = 0
) -> DataFrame:
    """One page of one account: the filter reaches the scan and only the page is ever sorted."""
    account = F.lit(account_id)
    outgoing = F.col("source_account_id") == account
    incoming = F.col("destination_account_id") == account
    return (
        transfers.where(outgoing | incoming)
        .withColumn("direction", F.when(outgoing, "outgoing").otherwise("incoming"))
        .orderBy(F.desc("created_at"), F.desc("transfer_id"))
        .offset(offset)
        .limit(limit)
    )


# ---- quotas, expiry, admission, visibility --------------------------------------------------


def account_quota(accounts: DataFrame, limit: int = ACCOUNTS_PER_SESSION) -> DataFrame:
    return _quota(accounts, "account_id", limit)


def transfer_quota(committed: DataFrame, limit: int = TRANSFERS_PER_SESSION) -> DataFrame:
    """Applied to committed transfers only: a replay never uses up quota."""
    return _quota(committed, "request_id", limit)


def _quota(rows: DataFrame, row_id: str, limit: int) -> DataFrame:
    marked = mark_first(rows, ["session_id"], ["created_at", row_id], limit, row_id)
    return marked.withColumn("status_code", F.when(F.col("accepted"), 201).otherwise(429))


def _at(as_of: datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def swept(
    sessions: DataFrame, accounts: DataFrame, transfers: DataFrame, as_of: datetime
) -> dict[str, DataFrame]:
    """What is left after removing expired sessions, their accounts, and transfers out of those.

    Anti joins keep rows without a session.
    """
    gone = sessions.where(F.col("expires_at") <= _at(as_of)).select("session_id")
    gone_accounts = accounts.join(gone, "session_id", "left_semi").select(
        F.col("account_id").alias("source_account_id")
    )
    return {
        "sessions": sessions.where(F.col("expires_at") > _at(as_of)),
        "accounts": accounts.join(gone, "session_id", "left_anti"),
        "transfers": transfers.join(gone_accounts, "source_account_id", "left_anti"),
    }


def admission(
    sessions: DataFrame,
    as_of: datetime,
    alive_limit: int = SESSIONS_ALIVE,
    recent_limit: int = SESSIONS_PER_MINUTE,
) -> DataFrame:
    """Would a new session be let in at ``as_of``?"""
    known = F.col("created_at") <= _at(as_of)
    alive = known & (F.col("expires_at") > _at(as_of))
    recent = alive & (F.col("created_at") > _at(as_of) - F.expr("INTERVAL 1 MINUTE"))
    return sessions.agg(
        F.count_if(alive).alias("alive"), F.count_if(recent).alias("recent")
    ).withColumn("busy", (F.col("alive") >= alive_limit) | (F.col("recent") >= recent_limit))


def admission_timeline(
    sessions: DataFrame,
    window: str = "1 minute",
    slide: str = "10 seconds",
    alive_limit: int = SESSIONS_ALIVE,
    recent_limit: int = SESSIONS_PER_MINUTE,
) -> DataFrame:
    """New sessions per sliding window, and the sessions alive at its end.

    Windows are grouped. The sessions alive are a prefix scan over +1 and -1 points in time, with a point
    per window that only reads: no task holds more than a range of points.
    """
    windows = sessions.groupBy(F.window("created_at", window, slide).alias("w")).agg(
        F.count("*").alias("new_sessions")
    )
    end = F.col("w.end").alias("at")
    none = F.lit(None).cast("bigint").alias("new_sessions")
    # of one instant: sessions that end or begin count before windows read
    reads = windows.select(F.lit(1).alias("kind"), end, F.lit(0).alias("step"), F.col("w.start").alias("start"), "new_sessions")
    steps = [
        sessions.select(
            F.lit(0).alias("kind"), F.col(at).alias("at"), F.lit(step).alias("step"), F.col(at).alias("start"), none
        )
        for at, step in (("created_at", 1), ("expires_at", -1))
    ]
    points = reads.unionByName(steps[0]).unionByName(steps[1]).withColumn("_all", F.lit(0))
    ranged = into_ranges(points, ["_all"], ["at", "kind"])
    alive = prefix_sums(ranged, ["_all"], ["at", "kind"], {"alive": F.col("step").cast("bigint")}, inclusive=True)
    return alive.where(F.col("kind") == 1).select(
        F.col("start").alias("window_start"),
        F.col("at").alias("window_end"),
        "new_sessions",
        "alive",
        ((F.col("alive") >= alive_limit) | (F.col("new_sessions") >= recent_limit)).alias("busy"),
    )


def visible_reads(reads: DataFrame, accounts: DataFrame) -> DataFrame:
    """200 where the account belongs to the reading session (no session reads no-session
    accounts), else 404.
    """
    owned = accounts.select(
        "account_id", F.col("session_id").alias("_owner"), F.lit(True).alias("_exists")
    )
    mine = F.col("_exists") & F.col("session_id").eqNullSafe(F.col("_owner"))
    return (
        reads.join(owned, "account_id", "left")
        .withColumn("status_code", F.when(mine, 200).otherwise(404))
        .drop("_owner", "_exists")
    )


def over_limit(balance: Column) -> Column:
    return balance > MAX_BALANCE_MINOR
