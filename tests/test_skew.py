"""The paths for hot keys give the same rows as the plain ones."""

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, at, rows
from tidemark.operators import ledger, ratelimit, retention, running, skew
from tidemark.plans.binding import RULE, Bank, Ledger

START = at("2026-01-01")


@pytest.fixture(scope="module")
def bank(spark):
    return Bank(spark, SMALL)


@pytest.fixture(scope="module")
def book(spark):
    return Ledger(spark, SMALL)


@pytest.mark.parametrize("hot_rows", [1, 25])
def test_retention(bank, hot_rows):
    plain = rows(retention.monthly_cohorts(bank.transactions, RULE))
    assert rows(retention.monthly_cohorts(bank.transactions, RULE, hot_rows)) == plain
    by_channel = (bank.customers, bank.accounts, bank.transactions, RULE)
    assert rows(retention.d30_by_channel(*by_channel, hot_rows)) == rows(
        retention.d30_by_channel(*by_channel)
    )


    assert rows(retention.fx_retention(bank.transactions, RULE, hot_rows)) == rows(
        retention.fx_retention(bank.transactions, RULE)
    )


@pytest.mark.parametrize("report", [retention.monthly_cohorts, retention.fx_retention])
def test_retention_shares_the_account_summary(bank, report):
    """Hot-key detection must reuse the anchor's shuffle instead of scanning again."""
    df = report(bank.transactions, RULE, hot_rows=25)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange [account_id" in plan


@pytest.fixture(params=["true", "false"])
def coalesced(spark, request):
    """Small ranges merged by adaptive execution, or left as they are."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param)
    yield
    spark.conf.unset(name)


def test_running_balance_of_one_giant_account(spark, coalesced):
    """A third of all postings on one account, many at the same instant."""
    random.seed(5)
    moves = [
        (f"t{i:05d}", "hot" if i % 3 == 0 else f"a{i % 50}", "sink", random.randint(1, 99))
        for i in range(3000)
    ]
    transfers = spark.createDataFrame(
        [(t, s, d, n, START + timedelta(seconds=i // 500)) for i, (t, s, d, n) in enumerate(moves)],
        "transfer_id string, source_account_id string, destination_account_id string, "
        "amount_minor bigint, created_at timestamp_ntz",
    )
    names = sorted({m[1] for m in moves} | {"sink"})
    accounts = spark.createDataFrame(
        [(n, 1000) for n in names], "account_id string, opening_balance_minor bigint"
    )
    found = running.running_balances(accounts, ledger.postings(transfers))
    expected, so_far = [], dict.fromkeys(names, 1000)
    for t, source, sink, amount in moves:
        for account, signed in ((source, -amount), (sink, amount)):
            so_far[account] += signed
            expected.append((account, t, so_far[account]))
    assert rows(found, "account_id", "transfer_id", "balance_after_minor") == sorted(expected)


def test_deep_pages_rank_in_parts(book, monkeypatch):
    plain = rows(ledger.history_pages(book.postings, 20, 30))
    monkeypatch.setattr(skew, "GROUP_LIMIT", 5)
    assert rows(ledger.history_pages(book.postings, 20, 30)) == plain


def test_small_ranks_are_trimmed_before_the_shuffle(book):
    page = ledger.history_pages(book.postings, 20, 0)
    assert "WindowGroupLimit" in page._jdf.queryExecution().executedPlan().toString()


def test_quota_cutoffs(book, monkeypatch):
    committed = book.journal.select("request_id", "session_id", "created_at")
    plain = rows(ledger.transfer_quota(committed, 7))
    assert sum(accepted for *_, accepted, _ in plain) == 7
    monkeypatch.setattr(skew, "GROUP_LIMIT", 3)
    assert rows(ledger.transfer_quota(committed, 7)) == plain


def reference_limiter(times, start, width, limit):
    window, count, verdicts = start, 0, []
    for t in times:
        if t >= window + width:
            window, count = t, 1
            verdicts.append(True)
        elif count >= limit:
            verdicts.append(False)
        else:
            count += 1
            verdicts.append(True)
    return verdicts


@pytest.mark.parametrize("seed", range(6))
def test_window_by_window_equals_request_by_request(seed):
    rng = np.random.default_rng(seed)
    times = np.sort(rng.integers(0, 40 + 400 * seed, size=300))
    passed, _, _ = ratelimit.pass_requests(times, 0, 0, 37, 4)
    assert passed.tolist() == reference_limiter(times, 0, 37, 4)


def test_limiter_resumes_where_it_stopped():
    times = np.sort(np.random.default_rng(9).integers(0, 900, size=400))
    whole, _, _ = ratelimit.pass_requests(times, 0, 0, 50, 7)
    start, used, parts = 0, 0, []
    for chunk in np.array_split(times, 13):
        passed, start, used = ratelimit.pass_requests(chunk, start, used, 50, 7)
        parts.append(passed)
    assert np.concatenate(parts).tolist() == whole.tolist()


@pytest.mark.parametrize("seed, width, limit", [(1, 37, 4), (2, 5, 1), (3, 4000, 7)])
def test_large_sessions_by_doubling_equal_the_walk(spark, coalesced, seed, width, limit):
    """Sessions past the bound, with ties, requests before the opening, and one session of a single window."""
    rng = np.random.default_rng(seed)
    sent = [("big", int(t)) for t in rng.integers(-20, 900, 260)] + [("other", int(t)) for t in rng.integers(0, 90, 60)]
    sent += [("small", int(t)) for t in rng.integers(0, 400, 20)]
    requests = spark.createDataFrame(
        [(i, s, START + timedelta(seconds=t)) for i, (s, t) in enumerate(sent)],
        "request_id bigint, session_id string, ts timestamp_ntz",
    )
    sessions = spark.createDataFrame(
        [(s, START, START + timedelta(seconds=800)) for s in ("big", "other", "small")],
        "session_id string, window_start timestamp_ntz, expires_at timestamp_ntz",
    )
    found = ratelimit.rate_limited(requests, sessions, limit, width, hot_rows=50)
    assert rows(found) == rows(ratelimit.rate_limited(requests, sessions, limit, width))
    for session in ("big", "other"):
        times = sorted((t, i) for i, (s, t) in enumerate(sent) if s == session and t < 800)
        verdicts = dict(zip([i for _, i in times], reference_limiter([t for t, _ in times], 0, width, limit)))
        assert {r.request_id: r.passed for r in found.collect() if r.session_id == session and r.passed is not None} == verdicts


def test_hot_keys_are_counted_exactly(spark):
    df = spark.range(30).select(F.when(F.col("id") < 10, "x").otherwise("y").alias("k"))
    assert rows(skew.hot_keys(df, "k", 11)) == [("y", 20)]
    assert rows(skew.hot_keys(df, "k", 10)) == [("x", 10), ("y", 20)]
