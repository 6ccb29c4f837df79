"""Streams: the same rows in any number and order of files give the same result."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, at, rows
from tidemark.plans import registry
from tidemark.streaming import jobs, partials, stateful

STREAMS = sorted(name for name in registry.named_queries() if name.startswith("stream_"))
STREAMED = ("events", "lineitem")


@pytest.fixture(scope="module", params=[80, 260])
def scattered(request, spark, tmp_path_factory):
    """The source tables with the streamed ones shuffled over many files."""
    folder = tmp_path_factory.mktemp(f"files{request.param}")
    for file in os.listdir(SMALL):
        name = file.removesuffix(".parquet")
        if name in STREAMED:
            source = spark.read.parquet(f"{SMALL}/{file}")
            source.repartition(request.param, F.rand(7)).write.parquet(f"{folder}/{file}")
        else:
            os.symlink(f"{SMALL}/{file}", folder / file)
    return str(folder)


@pytest.fixture(scope="module")
def from_one_file(spark):
    found = {}

    def result(name):
        if name not in found:
            found[name] = rows(registry.named_queries()[name](spark, SMALL))
        return found[name]

    return result


@pytest.mark.parametrize("name", STREAMS)
def test_files_do_not_matter(spark, scattered, from_one_file, name):
    found = rows(registry.named_queries()[name](spark, scattered))
    assert found == from_one_file(name)
    assert found


def moves(spark, path, *parts):
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return jobs.file_stream(spark, path, max_files=1)


def test_a_later_file_may_hold_an_earlier_funding(spark, tmp_path, tx):
    late = tx((1, "2026-01-03", "cash_in", "completed", 8), (2, "2026-01-04", "cash_in", "completed", 9))
    early = tx(
        (1, "2026-01-02", "cash_in", "completed", 5),
        (1, "2026-01-01", "cash_in", "completed", 6),
        (2, "2026-01-01", "cash_in", "failed", 7),
    )
    found = jobs.first_fundings(moves(spark, str(tmp_path / "moves"), late, early))
    assert [(a, float(v)) for a, v in rows(found, "account_id", "amount_gbp")] == [(1, 6.0), (2, 9.0)]


def test_activity_windows_are_half_open(spark, tmp_path, tx):
    fundings = tx((1, "2026-01-01", "cash_in", "completed", 5), (2, "2026-01-05", "cash_in", "completed", 5))
    spent = tx(
        (1, "2026-01-31", "card_payment", "completed", 1),
        (1, "2026-03-01 23:59:59", "card_payment", "completed", 1),
        (1, "2026-03-02", "card_payment", "completed", 1),
        (1, "2026-02-01", "card_payment", "failed", 1),
        (2, "2026-02-03", "card_payment", "completed", 1),
        (2, "2026-02-04", "card_payment", "completed", 1),
    )
    sides = [moves(spark, str(tmp_path / n), df) for n, df in (("fundings", fundings), ("spent", spent))]
    assert rows(jobs.activity_after_funding(*sides, 30, 60, "300 days")) == [(1, 2), (2, 1)]


def test_only_closed_days_are_reported(spark, tmp_path, tx):
    days = [
        tx((1, f"{day} 10:00:00", "cash_in", "completed", 5))
        for day in ("2026-01-09", "2026-01-01", "2026-01-02", "2026-01-01")
    ]
    found = jobs.daily_economics(moves(spark, str(tmp_path / "moves"), *days))
    assert rows(found, "day", "completed_transactions") == [(at("2026-01-01"), 2), (at("2026-01-02"), 1)]


def test_a_stream_without_files_is_empty(spark, tmp_path, tx):
    path = str(tmp_path / "none")
    tx().write.parquet(path)
    assert rows(jobs.first_fundings(jobs.file_stream(spark, path))) == []


def test_partials_stay_few_and_survive_repeats(spark, tmp_path):
    folder = str(tmp_path / "out")
    merge = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    part = lambda number: spark.createDataFrame([(number % 3, 1), (9, number)], "k int, n long")
    for number in range(40):
        # a new driver at any batch goes on from the manifest, and repeats its last batch
        parts = partials.Partials(spark, folder, merge, width=3)
        if number:
            parts.put(part(number - 1), number - 1)
        parts.put(part(number), number)
    assert parts.levels == partials.Partials(spark, folder, merge, 3).levels
    assert [len(level) for level in parts.levels] == [1, 1, 1, 1]
    held = [name for name in os.listdir(folder) if not name.endswith((".json", ".crc"))]
    assert len(held) == 4
    assert rows(parts.read(part(0))) == [(0, 14), (1, 13), (2, 13), (9, sum(range(40)))]


# ---- keyed state --------------------------------------------------------------------------------

REQUESTS = "request_id long, session_id string, idempotency_key string, ts timestamp_ntz"
SESSIONS = "session_id string, created_at timestamp_ntz, expires_at timestamp_ntz"


def sent(spark, *rows_):
    return spark.createDataFrame([(i, s, "k", at(f"2026-03-01 {t}")) for i, s, t in rows_], REQUESTS)


def born(spark, *rows_):
    return spark.createDataFrame([(s, at(f"2026-03-01 {a}"), at(f"2026-03-01 {b}")) for s, a, b in rows_], SESSIONS)


def test_a_key_returns_after_its_window(spark, tmp_path):
    parts = [sent(spark, (i, "s", t)) for i, t in enumerate(["10:00:59", "10:00:00", "10:01:00", "10:01:30", "10:02:00"])]
    found = jobs.unique_requests(moves(spark, str(tmp_path / "sent"), *parts), 60, "1 hour")
    assert sorted(r.request_id for r in found.collect()) == [1, 2, 4]


def test_late_rows_are_set_aside(spark, tmp_path):
    parts = [sent(spark, (i, "s", t)) for i, t in enumerate(["10:00:00", "12:00:00", "10:00:30", "12:00:01"])]
    found = jobs.unique_requests(moves(spark, str(tmp_path / "sent"), *parts), 60, "10 minutes")
    assert rows(found, "request_id", "late") == [(0, False), (1, False), (2, True)]


def test_requests_meet_their_sessions(spark, tmp_path):
    sessions = moves(spark, str(tmp_path / "sessions"), born(spark, ("a", "10:00:00", "10:30:00")))
    first = sent(spark, (1, "a", "09:59:59"), (2, "a", "10:00:00"), (3, "a", "10:00:10"), (4, "a", "10:00:20"))
    later = sent(spark, (5, "a", "10:01:00"), (6, "a", "10:29:59"), (7, "a", "10:30:00"), (8, "b", "10:00:00"))
    requests = moves(spark, str(tmp_path / "sent"), later, first)
    found = jobs.rate_limited(requests, sessions, 2, 60, "1 hour")
    passed = {r.request_id: r.passed for r in found.collect()}
    assert passed == {1: None, 2: True, 3: True, 4: False, 5: True, 6: True, 7: None, 8: None}
    ended = jobs.expired_sessions(requests, sessions, "1 hour")
    assert rows(ended, "session_id", "outcome", "request_id") == [
        ("a", "expired", None), ("a", "refused", 1), ("a", "refused", 7), ("b", "refused", 8),
    ]


def test_state_ends_with_its_sessions(spark, tmp_path):
    """Files in order and a short delay: state holds the sessions alive, not all that ever were."""
    hours = range(12)
    sessions = [born(spark, *[(f"s{h}-{n}", f"{h:02}:00:00", f"{h:02}:20:00") for n in range(5)]) for h in hours]
    requests = [
        sent(spark, *[(100 * h + 10 * n + m, f"s{h}-{n}", f"{h:02}:0{m}:00") for n in range(5) for m in range(3)])
        for h in hours
    ]
    reports = []
    ended = jobs.expired_sessions(
        moves(spark, str(tmp_path / "sent"), *requests),
        moves(spark, str(tmp_path / "sessions"), *sessions),
        "10 minutes",
        reports.append,
    )
    assert ended.where("outcome = 'expired'").count() == 60
    held = [s["numRowsTotal"] for r in reports for s in r["stateOperators"]]
    assert max(held) < 120 and held[-1] == 0


def test_interval_join_forgets_what_has_passed(spark, tmp_path, tx):
    months = [f"2025-{m:02}" for m in range(1, 13)]
    fundings = [tx((n, f"{m}-01", "cash_in", "completed", 5)) for n, m in enumerate(months)]
    spent = [
        tx(*[(n - back, f"{m}-03", "card_payment", "completed", 1) for back in (0, 1, 2, 3) if n >= back])
        for n, m in enumerate(months)
    ]
    reports = []
    sides = [moves(spark, str(tmp_path / k), *df) for k, df in (("fundings", fundings), ("spent", spent))]
    found = jobs.activity_after_funding(*sides, 30, 60, "1 day", reports.append)
    whole = jobs.activity_after_funding(*sides, 30, 60, "2000 days")
    assert rows(found) == rows(whole) and found.count() == 11
    assert max(s["numRowsTotal"] for r in reports for s in r["stateOperators"]) < 25


def many(spark, keys, times):
    """Requests of many sessions at the same seconds, as (id, session, time)."""
    ids = spark.range(keys * len(times))
    second = F.element_at(F.array(*[F.lit(t) for t in times]), (F.col("id") % len(times) + 1).cast("int"))
    return ids.select(
        F.col("id").alias("request_id"),
        F.concat(F.lit("s"), F.floor(F.col("id") / len(times))).alias("session_id"),
        F.lit("k").alias("idempotency_key"),
        F.concat(F.lit("2026-03-01 "), second).cast("timestamp_ntz").alias("ts"),
    )


def test_keys_share_buckets_but_not_windows(spark, tmp_path):
    """State rows follow the number of buckets, not that of keys; every key has windows of its own."""
    times, reports = ["10:00:30", "10:00:00", "10:01:00", "10:02:30"], []
    keys = 20 * stateful.BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = moves(spark, str(tmp_path / "sent"), many(spark, keys, times))
    found = jobs.unique_requests(stream, 60, "1 hour", reports.append)
    passed = found.groupBy((F.col("request_id") % 4).alias("n")).agg(
        F.count("*").alias("rows"), F.count_distinct("scoped_key").alias("keys")
    )
    assert rows(passed) == [(n, keys, keys) for n in (1, 2, 3)]
    assert max(s["numRowsTotal"] for r in reports for s in r["stateOperators"]) < keys
    assert reports[-1]["stateOperators"][0]["numRowsTotal"] == 0


def test_sessions_share_buckets(spark, tmp_path):
    """Sessions of one bucket open, expire and turn requests away each at its own time."""
    keys = 4 * stateful.BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent_at = many(spark, keys, ["10:05:00", "10:10:00"])
    minute = F.floor(F.col("id") % 10).cast("string")
    opened = spark.range(keys).select(
        F.concat(F.lit("s"), F.col("id")).alias("session_id"),
        F.lit("2026-03-01 10:00:00").cast("timestamp_ntz").alias("created_at"),
        F.concat(F.lit("2026-03-01 10:0"), minute, F.lit(":30")).cast("timestamp_ntz").alias("expires_at"),
    )
    requests, sessions = moves(spark, str(tmp_path / "sent"), sent_at), moves(spark, str(tmp_path / "sessions"), opened)
    reports = []
    ended = jobs.expired_sessions(requests, sessions, "1 hour", reports.append)
    counts = ended.groupBy("outcome", F.minute("at").alias("m")).agg(F.count_distinct("session_id").alias("n"))
    of = [sum(1 for k in range(keys) if k % 10 == m) for m in range(10)]
    want = [("expired", m, n) for m, n in enumerate(of)] + [("refused", 5, sum(of[:5])), ("refused", 10, keys)]
    assert rows(counts) == sorted(want, key=str)
    assert max(s["numRowsTotal"] for r in reports for s in r["stateOperators"]) < keys


def test_small_files_and_many_partitions_cost_few_stores(spark, tmp_path):
    """Tasks of keyed state follow neither the number of files nor, beyond the cores, that of shuffle partitions."""
    keys, setting = 100, "spark.sql.shuffle.partitions"
    sent_at = many(spark, keys, ["10:05:00", "10:10:00"])
    sent_at.repartition(2 * stateful.BUCKETS + 2).write.parquet(str(tmp_path / "sent"))
    opened = spark.range(keys).select(
        F.concat(F.lit("s"), F.col("id")).alias("session_id"),
        F.lit("2026-03-01 10:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("2026-03-01 10:07:00").cast("timestamp_ntz").alias("expires_at"),
    )
    sessions, before, reports = moves(spark, str(tmp_path / "sessions"), opened), spark.conf.get(setting), []
    spark.conf.set(setting, "40")
    try:
        requests = jobs.file_stream(spark, str(tmp_path / "sent"))
        ended = jobs.expired_sessions(requests, sessions, "1 hour", reports.append)
        assert spark.conf.get(setting) == "40"
    finally:
        spark.conf.set(setting, before)
    assert rows(ended.groupBy("outcome").count()) == [("expired", keys), ("refused", keys)]
    assert len([r for r in reports if r["numInputRows"] > 1]) == 1
    stores = {s["numShufflePartitions"] for r in reports for s in r["stateOperators"]}
    assert stores == {stateful.STORES_PER_CORE * spark.sparkContext.defaultParallelism}
