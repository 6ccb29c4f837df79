"""Ledger rules on hand-made requests."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, one, rows
from tidemark.operators import ledger, ratelimit, running

A, B, C = (f"00000000-0000-4000-8000-{i:012d}" for i in (1, 2, 3))
NOON = at("2026-03-01 12:00:00")
RAW = "request_id bigint, session_id string, idempotency_key string, body string, ts timestamp_ntz"
TYPED = (
    "request_id bigint, session_id string, idempotency_key string, source_account_id string, "
    "destination_account_id string, amount_minor bigint, currency string, ts timestamp_ntz"
)


def body(**changes):
    fields = dict(source_account_id=A, destination_account_id=B, amount_minor=100)
    fields = {k: v for k, v in (fields | changes).items() if v is not ...}
    return json.dumps(fields)


@pytest.fixture(scope="module")
def reason(spark):
    def of(text, key="key-1"):
        df = spark.createDataFrame([(1, None, key, text, NOON)], RAW)
        return one(ledger.validated_transfers(df))

    return of


@pytest.mark.parametrize("amount", [0, -1, 1.5, 1.0, "100", True, None, 1_000_000_000_001, ...])
def test_bad_amounts(reason, amount):
    assert reason(body(amount_minor=amount))["reason"] == "amount_minor"


@pytest.mark.parametrize("amount", [1, 100, 1_000_000_000_000])
def test_good_amounts(reason, amount):
    row = reason(body(amount_minor=amount))
    assert (row["reason"], row["amount_minor"], row["currency"]) == (None, amount, "GBP")


@pytest.mark.parametrize(
    "text, expected",
    [
        (body(currency="USD"), "currency"),
        (body(currency=None), "currency"),
        (body(currency=7), "currency"),
        (body(admin=True), "unknown_field"),
        (body(destination_account_id=A), "same_account"),
        (body(source_account_id="not-a-uuid"), "source_account_id"),
        (body(source_account_id=5), "source_account_id"),
        (body(destination_account_id=...), "destination_account_id"),
        ("{", "malformed_body"),
        ("", "malformed_body"),
        ("[]", "malformed_body"),
        ("null", "malformed_body"),
        ('"text"', "malformed_body"),
    ],
)
def test_bad_bodies(reason, text, expected):
    assert reason(text)["reason"] == expected


@pytest.mark.parametrize(
    "spelling", [A.upper(), A.replace("-", ""), "{" + A + "}", "urn:uuid:" + A]
)
def test_uuid_spellings_are_one_account(reason, spelling):
    row = reason(body(source_account_id=spelling))
    assert (row["reason"], row["source_account_id"]) == (None, A)
    assert reason(body(destination_account_id=spelling))["reason"] == "same_account"


@pytest.mark.parametrize(
    "key, good",
    [("a", 1), ("A.b_c:d-9", 1), ("k" * 128, 1), ("k" * 129, 0), ("", 0), (" ", 0)]
    + [("a b", 0), ("a\n", 0), (None, 0)],
)
def test_key_pattern(reason, key, good):
    assert reason(body(), key)["reason"] == (None if good else "idempotency_key")


@pytest.mark.parametrize(
    "fields, expected",
    [
        (dict(owner_name="  "), "owner_name"),
        (dict(), "owner_name"),
        (dict(owner_name=5), "owner_name"),
        (dict(owner_name="x" * 101), "owner_name"),
        (dict(owner_name="A", opening_balance_minor=-1), "opening_balance_minor"),
        (dict(owner_name="A", opening_balance_minor=0.5), "opening_balance_minor"),
        (dict(owner_name="A", opening_balance_minor=None), "opening_balance_minor"),
        (dict(owner_name="A", opening_balance_minor=10**12 + 1), "opening_balance_minor"),
        (dict(owner_name="A", currency="USD"), "currency"),
        (dict(owner_name="A", admin=True), "unknown_field"),
        (dict(owner_name="\t Ann \n"), None),
        (dict(owner_name="x" * 100, opening_balance_minor=10**12), None),
    ],
)
def test_account_requests(spark, fields, expected):
    df = spark.createDataFrame([(1, None, "k", json.dumps(fields), NOON)], RAW)
    row = one(ledger.validated_accounts(df))
    assert row["reason"] == expected
    if fields.get("owner_name") == "\t Ann \n":
        assert (row["owner_name"], row["opening_balance_minor"]) == ("Ann", 0)


def test_split_valid(spark):
    df = spark.createDataFrame(
        [(1, None, "k", body(), NOON), (2, None, "k", body(amount_minor=0), NOON)], RAW
    )
    valid, bad = ledger.split_valid(ledger.validated_transfers(df))
    assert rows(valid, "request_id") == [(1,)]
    assert rows(bad, "request_id", "reason") == [(2, "amount_minor")]


@pytest.fixture(scope="module")
def book(spark):
    """accounts(id, session, opening) and requests(id, session, key, source, dest, amount)."""

    def build(holders, asked):
        accounts = spark.createDataFrame(
            [(a, s, o, o, NOON) for a, s, o in holders],
            "account_id string, session_id string, opening_balance_minor bigint, "
            "balance_minor bigint, created_at timestamp_ntz",
        )
        requests = spark.createDataFrame(
            [
                (i, s, k, src, dst, n, "GBP", NOON + timedelta(seconds=i))
                for i, s, k, src, dst, n in asked
            ],
            TYPED,
        )
        return accounts, requests

    return build


def outcomes(accounts, requests):
    committed = ledger.journal(requests, accounts)
    found = ledger.classified_requests(requests, committed)
    return dict(rows(found, "request_id", "outcome"))


def test_replay_conflict_and_failed_attempt(book):
    accounts, requests = book(
        [(A, None, 1000), (B, None, 0)],
        [
            (1, None, "k", C, B, 250),  # unknown source: fails and reserves nothing
            (2, None, "k", A, B, 250),
            (3, None, "k", A, B, 250),
            (4, None, "k", A, B, 251),
            (5, None, "other", A, C, 1),
        ],
    )
    assert outcomes(accounts, requests) == {
        1: "rejected",
        2: "committed",
        3: "replayed",
        4: "conflict",
        5: "rejected",
    }


def test_keys_are_scoped_to_sessions(book):
    accounts, requests = book(
        [(A, "s1", 100), (B, "s1", 0), (C, "s2", 0)],
        [(1, "s1", "same", A, B, 1), (2, "s2", "same", A, B, 1), (3, "s1", "x", A, C, 1)],
    )
    assert outcomes(accounts, requests) == {1: "committed", 2: "rejected", 3: "rejected"}


def test_eight_identical_requests_commit_once(book):
    accounts, requests = book(
        [(A, None, 1000), (B, None, 0)], [(i, None, "k", A, B, 250) for i in range(8)]
    )
    assert sorted(outcomes(accounts, requests).values()) == ["committed"] + ["replayed"] * 7


@pytest.fixture(scope="module")
def six(spark):
    """Six transfers of 150 out of 1000."""
    transfers = spark.createDataFrame(
        [(f"t{i}", A, B, 150, NOON + timedelta(seconds=i // 2)) for i in range(6)],
        "transfer_id string, source_account_id string, destination_account_id string, "
        "amount_minor bigint, created_at timestamp_ntz",
    )
    accounts = spark.createDataFrame(
        [(A, None, 1000, 100), (B, None, 0, 901)],
        "account_id string, session_id string, opening_balance_minor bigint, "
        "balance_minor bigint",
    )
    return accounts, transfers


def test_balances_and_conservation(six):
    accounts, transfers = six
    posted = ledger.postings(transfers)
    found = rows(
        ledger.balances(accounts, posted), "account_id", "computed_balance_minor", "drift_minor"
    )
    assert found == [(A, 100, 0), (B, 900, 1)]
    assert one(ledger.conservation(accounts, posted))["conserved"]


def test_running_balance_and_flags(six):
    accounts, transfers = six
    poor = accounts.withColumn("opening_balance_minor", F.lit(400).cast("bigint"))
    found = running.running_balances(poor, ledger.postings(transfers))
    after = rows(found.where(F.col("account_id") == A), "transfer_id", "balance_after_minor")
    assert after == [(f"t{i}", 400 - 150 * (i + 1)) for i in range(6)]
    summary = running.overdraft_summary(found).where(F.col("account_id") == A)
    assert one(summary)["overdrawn_postings"] == 4
    rich = accounts.withColumn("opening_balance_minor", F.lit(9 * 10**15 - 100).cast("bigint"))
    over = running.running_balances(rich, ledger.postings(transfers)).where("over_limit")
    assert over.count() == 6


def test_history_pages(six):
    _, transfers = six
    posted = ledger.postings(transfers)
    page = rows(ledger.history_pages(posted, 2, 0), "account_id", "position", "transfer_id")
    assert page == [(A, 1, "t5"), (A, 2, "t4"), (B, 1, "t5"), (B, 2, "t4")]
    last = rows(ledger.history_pages(posted, 2, 5), "account_id", "transfer_id", "direction")
    assert last == [(A, "t0", "outgoing"), (B, "t0", "incoming")]
    one_account = ledger.account_history(transfers, B, limit=2, offset=1).collect()
    assert [(r.transfer_id, r.direction) for r in one_account] == [
        ("t4", "incoming"),
        ("t3", "incoming"),
    ]


@pytest.mark.parametrize("limit, offset", [(0, 0), (101, 0), (1, -1), (1, 10_001)])
def test_page_bounds(six, limit, offset):
    with pytest.raises(ValueError):
        ledger.history_pages(ledger.postings(six[1]), limit, offset)


def test_account_quota(spark):
    created = [(i, "s", NOON + timedelta(seconds=i)) for i in range(8)]
    created += [(100 + i, None, NOON) for i in range(9)]  # no session, no quota
    df = spark.createDataFrame(
        created, "account_id bigint, session_id string, created_at timestamp_ntz"
    )
    codes = rows(ledger.account_quota(df).groupBy("session_id", "status_code").count())
    assert codes == [("s", 201, 5), ("s", 429, 3), (None, 201, 9)]


def limited(spark, seconds, limit=60, window=60, lifetime=ledger.SESSION_LIFETIME):
    requests = spark.createDataFrame(
        [(i, "s", NOON + timedelta(seconds=s)) for i, s in enumerate(seconds)],
        "request_id bigint, session_id string, ts timestamp_ntz",
    )
    sessions = spark.createDataFrame(
        [("s", NOON, NOON + lifetime)],
        "session_id string, window_start timestamp_ntz, expires_at timestamp_ntz",
    )
    found = ratelimit.rate_limited(requests, sessions, limit, window)
    return [p for _, p in rows(found.select("request_id", "passed"))], found


def test_sixty_per_minute(spark):
    # 61 within the first minute, one exactly a minute after the session began.
    _, found = limited(spark, [0.5 * i for i in range(61)] + [60])
    verdicts = dict(rows(found, "request_id", "passed"))
    assert [i for i, ok in verdicts.items() if not ok] == [60]


def test_expired_requests_are_not_counted(spark):
    # The session ends at 100: nothing from then on passes or fails the limit.
    verdicts, _ = limited(spark, [70, 99.999, 100, 130], limit=1, lifetime=timedelta(seconds=100))
    assert verdicts == [True, False, None, None]


def test_window_starts_at_the_request_that_opens_it(spark):
    # The window opened at 70 lasts until 130, so the fourth request there is rejected.
    verdicts, _ = limited(spark, [70, 80, 90, 129.999, 130], limit=3)
    assert verdicts == [True, True, True, False, True]


def test_expiry_cascades_and_keeps_sessionless(spark):
    sessions = spark.createDataFrame(
        [("old", NOON), ("new", NOON + timedelta(seconds=1))],
        "session_id string, expires_at timestamp_ntz",
    )
    accounts = spark.createDataFrame(
        [(A, "old"), (B, "new"), (C, None)], "account_id string, session_id string"
    )
    transfers = spark.createDataFrame(
        [("t1", A), ("t2", B), ("t3", C)], "transfer_id string, source_account_id string"
    )
    left = ledger.swept(sessions, accounts, transfers, NOON)
    assert rows(left["sessions"], "session_id") == [("new",)]
    assert rows(left["accounts"], "account_id") == [(B,), (C,)]
    assert rows(left["transfers"], "transfer_id") == [("t2",), ("t3",)]


def test_admission(spark):
    def state(ages, **limits):
        made = [
            (NOON - timedelta(seconds=a), NOON - timedelta(seconds=a) + ledger.SESSION_LIFETIME)
            for a in ages
        ]
        df = spark.createDataFrame(made, "created_at timestamp_ntz, expires_at timestamp_ntz")
        return tuple(one(ledger.admission(df, NOON, **limits)).values())

    assert state([10] * 19 + [60] * 5) == (24, 19, False)
    assert state([10] * 20) == (20, 20, True)
    assert state([100] * 200) == (200, 0, True)
    assert state([1800] * 300) == (0, 0, False)


def test_visibility_is_null_safe(spark):
    accounts = spark.createDataFrame(
        [(A, "s1"), (B, None)], "account_id string, session_id string"
    )
    reads = spark.createDataFrame(
        [(1, "s1", A), (2, "s2", A), (3, None, A), (4, None, B), (5, "s1", B), (6, None, C)],
        "request_id bigint, session_id string, account_id string",
    )
    codes = rows(ledger.visible_reads(reads, accounts), "request_id", "status_code")
    assert [c for _, c in codes] == [200, 404, 404, 200, 404, 404]


def test_sums_outgrow_64_bits(spark):
    moves = spark.range(10_000_000).select(
        F.lit(A).alias("account_id"), F.lit(ledger.MAX_TRANSFER_MINOR).alias("signed_minor")
    )
    accounts = spark.createDataFrame(
        [(A, 0, 0)], "account_id string, opening_balance_minor bigint, balance_minor bigint"
    )
    found = one(ledger.balances(accounts, moves))
    assert found["computed_balance_minor"] == 10**19
    assert found["drift_minor"] == -(10**19)


def test_the_last_of_a_repeated_field_counts(reason):
    text = body(amount_minor=5).replace("{", '{"amount_minor": "x", ', 1)
    assert (reason(text)["reason"], reason(text)["amount_minor"]) == (None, 5)
    assert reason(text.replace("amount_minor", "extra", 1))["reason"] == "unknown_field"


def test_outcomes_in_the_order_a_service_decides(spark):
    def request(i, minute, key, destination=B, amount=5, session="s"):
        return (i, session, key, body(destination_account_id=destination, amount_minor=amount), NOON + timedelta(minutes=minute))

    requests = spark.createDataFrame(
        [
            request(1, 0, "a"),
            request(2, 1, "a"),
            request(3, 2, "a", amount=6),
            request(4, 3, "b", destination=C),  # of another session
            request(5, 4, "b"),
            request(6, 5, "c"),  # the session has its two transfers
            request(7, 5, "a"),  # but a replay is still answered
            request(8, 6, "d", amount=0),
            request(9, 30, "a"),  # expired
            request(10, 1, "a", session="unknown"),
            request(11, 1, "a", session=None),
        ],
        RAW,
    )
    sessions = spark.createDataFrame(
        [("s", NOON + timedelta(minutes=30))], "session_id string, expires_at timestamp_ntz"
    )
    accounts = spark.createDataFrame(
        [(A, "s"), (B, "s"), (C, "t")], "account_id string, session_id string"
    )
    found = ledger.outcomes(requests, sessions, accounts, limit=2)
    assert rows(found, "request_id", "status_code") == sorted(
        [(1, 201), (2, 200), (3, 409), (4, 404), (5, 201), (6, 429), (7, 200), (8, 422), (9, 401), (10, 401), (11, 401)],
        key=str,
    )
