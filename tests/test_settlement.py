"""Settlement in rounds against one request after the other, and the scans it stands on."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import at, rows
from tidemark.operators import scan, settlement
from tidemark.plans import oracle, registry

REQUEST = (
    "request_id bigint, session_id string, idempotency_key string, source_account_id string, "
    "destination_account_id string, amount_minor bigint, currency string, ts timestamp_ntz"
)
ACCOUNT = "account_id string, session_id string, opening_balance_minor bigint"


def brute(requests, accounts, limit, balance_limit):
    """{request_id: booked} of the requests between own accounts, one after the other."""
    owner = {a: s for a, s, _ in accounts}
    balance = {a: b for a, _, b in accounts}
    keys, used, booked = set(), {}, {}
    for i, s, key, source, target, amount, _, _ in sorted(requests, key=lambda r: (r[7], r[0])):
        if any(a not in owner or owner[a] != s for a in (source, target)):
            continue
        full = limit is not None and s is not None and used.get(s, 0) >= limit
        can = (
            (s, key) not in keys
            and not full
            and balance[source] >= amount
            and balance[target] + amount <= balance_limit
        )
        if can:
            balance[source] -= amount
            balance[target] += amount
            keys.add((s, key))
            used[s] = used.get(s, 0) + 1
        booked[i] = can
    return booked


def made(seed, n=130, users=8):
    rng = random.Random(seed)
    accounts = [(f"a{u}", [None, "s1", "s1", "s2"][u % 4], rng.randrange(0, 400)) for u in range(users)]
    requests = []
    for i in range(n):
        source, target = rng.sample(range(users), 2)
        if rng.random() < 0.8:
            target = (source + 4) % users if source % 4 != 1 else rng.choice([(source + 1) % users, (source + 4) % users])
        session = accounts[source][1] if rng.random() < 0.95 else "s9"
        when = at("2026-03-01") + (at("2026-03-02") - at("2026-03-01")) * (rng.randrange(n // 2) / n)
        key = f"k{rng.randrange(n // 2)}"
        requests.append((i, session, key, f"a{source}", f"a{target}", rng.randrange(1, 150), "GBP", when))
    return requests, accounts


@pytest.mark.parametrize("seed, limit, tail", [(1, None, 0), (2, 12, 0), (3, 20, 20), (4, 15, 10_000)])
def test_rounds_decide_as_one_after_the_other(spark, seed, limit, tail):
    requests, accounts = made(seed)
    found = settlement.settle(
        spark.createDataFrame(requests, REQUEST), spark.createDataFrame(accounts, ACCOUNT), limit, 500, tail
    ).collect()
    want = brute(requests, accounts, limit, 500)
    assert {r.request_id: r.booked for r in found} == want
    assert len(found) == len(want) and len(set(want.values())) == 2
    rounds = {r["round"] for r in found}
    assert rounds == {1} if tail > len(requests) else len(rounds) > 1


def test_a_refused_request_reserves_nothing(spark):
    accounts = spark.createDataFrame([("a", "s", 100), ("b", "s", 0)], ACCOUNT)
    sent = [("a", "b", 500, 1), ("b", "a", 10, 2), ("a", "b", 60, 3), ("b", "a", 10, 4), ("a", "b", 60, 5)]
    keys = ["k", "r", "k", "r", "x"]
    requests = spark.createDataFrame(
        [(i, "s", k, s, d, n, "GBP", at(f"2026-03-01 12:0{m}:00")) for i, (k, (s, d, n, m)) in enumerate(zip(keys, sent))],
        REQUEST,
    )
    found = settlement.settle(requests, accounts, tail=0)
    assert rows(found, "request_id", "booked") == [(0, False), (1, False), (2, True), (3, True), (4, False)]


def test_no_requests(spark):
    empty = spark.createDataFrame([], REQUEST)
    accounts = spark.createDataFrame([("a", "s", 100)], ACCOUNT)
    assert settlement.settle(empty, accounts).count() == 0


def test_every_code_occurs(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    for name in ("customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    df = registry.named_queries()["ledger_settlement"](spark, folder)
    ours = rows(df, "request_id", "session_id", "status_code", "code")
    theirs = con.execute(oracle.oracle_sql()["ledger_settlement"]).fetchall()
    assert ours == sorted(theirs, key=str)
    assert {(r[2], r[3]) for r in ours} >= {
        (200, None), (201, None), (401, "session_expired"), (409, "insufficient_funds"), (409, "balance_limit"),
        (409, "idempotency_conflict"), (429, "transfer_limit"), (404, "account_not_found"),
    }


def test_scans_cross_ranges(spark):
    rng = random.Random(3)
    values = [(rng.choice("aab"), i, rng.randrange(-9, 9)) for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = scan.into_ranges(spark.createDataFrame(values, "key string, at int, n long"), ["key"], ["at"])
        assert ranged.where("key = 'a'").select("_range").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    odd = F.when(F.col("n") % 2 != 0, F.col("at"))
    found = scan.prefix_sums(ranged, ["key"], ["at"], {"before": F.col("n")})
    found = scan.prefix_sums(found, ["key"], ["at"], {"upto": F.col("n")}, inclusive=True)
    found = scan.next_values(found, ["key"], ["at"], odd, "next_odd")
    for r in found.collect():
        own = [(i, n) for k, i, n in values if k == r.key]
        assert r.before == sum(n for i, n in own if i < r["at"])
        assert r.upto == r.before + r.n
        assert r.next_odd == min((i for i, n in own if i > r["at"] and n % 2), default=None)
