"""Readers and writers: typing, NULLs, failures, and replacing a table set at once."""

from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import SMALL, at, rows
from tidemark.operators import events
from tidemark.operators.ledger import account_history, postings
from tidemark.plans import registry
from tidemark.plans.binding import Bank
from tidemark.schemas import TABLES
from tidemark.session import run_dir, shared_dir
from tidemark.sources import history, sinks, snapshots, tables


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_csv_types_and_nulls(spark, tmp_path):
    path = write(
        tmp_path,
        "customers.csv",
        "customer_id,signup_ts,country_code,age,acquisition_channel,device_os,referral_code_used\n"
        "1,2026-01-01 10:11:12,GB,30,organic,iOS,True\n"
        "2,2026-01-02 00:00:00,,31,referral,Android,False\n",
    )
    df = tables.read_csv(spark, path, TABLES["customers"].schema)
    assert rows(df) == [
        (1, at("2026-01-01 10:11:12"), "GB", 30, "organic", "iOS", True),
        (2, at("2026-01-02"), None, 31, "referral", "Android", False),
    ]
    assert df.schema["age"].dataType.simpleString() == "smallint"


def test_csv_column_subset_is_pruned(spark, tmp_path):
    path = write(
        tmp_path,
        "x.csv",
        "account_id,customer_id,opened_ts,plan_tier,base_currency\n1,2,2026-01-01,premium,GBP\n",
    )
    df = tables.read_csv(spark, path, TABLES["accounts"].schema, ["customer_id"])
    assert rows(df) == [(2,)]
    assert "ReadSchema: struct<customer_id:bigint>" in df._jdf.queryExecution().toString()


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_csv(spark, str(tmp_path / "none.csv"), TABLES["customers"].schema)


def test_malformed_row_fails(spark, tmp_path):
    path = write(tmp_path, "bad.csv", "a,b\n1,x\nnot-a-number,y\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, path, "a bigint, b string").collect()


def test_wrong_header_fails(spark, tmp_path):
    path = write(tmp_path, "bad.csv", "b,a\n1,2\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, path, "a bigint, b bigint").collect()


def test_csv_writer_counts_and_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a,b"), (2, "", 'q"q')], "n bigint, x string, y string")
    counts = sinks.write_csv_tables({"t": df}, str(tmp_path))
    assert counts == {"t": 2}
    back = tables.read_csv(spark, f"{tmp_path}/t.csv", df.schema)
    assert [r[0] for r in rows(back)] == [1, 2]
    assert rows(back.where("n = 1"), "x") == [(None,)]


def test_publish_replaces_all_tables_together(spark, tmp_path):
    folder = str(tmp_path)
    old = {"a": spark.range(3), "b": spark.range(4)}
    sinks.publish(spark, old, folder)
    failing = {
        "a": spark.range(30),
        "b": spark.range(1).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id")),
    }
    with pytest.raises(Exception):
        sinks.publish(spark, failing, folder)
    assert {n: t.count() for n, t in sinks.published(spark, folder).items()} == {"a": 3, "b": 4}
    sinks.publish(spark, {"a": spark.range(30)}, folder)
    assert {n: t.count() for n, t in sinks.published(spark, folder).items()} == {"a": 30}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark))
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_transfer_series_page(spark):
    series = tables.transfer_series(spark.range(1, 5001))
    page = account_history(series, tables.series_account(42)).collect()
    # Account 42 sends transfers i = 42 and receives i = 41 (both modulo 1000).
    seconds = [(r.created_at - at("2026-01-01")).total_seconds() for r in page]
    expected = sorted((1000 * k + i for k in range(5) for i in (41, 42)), reverse=True)
    assert seconds == expected
    assert [r.direction for r in page] == ["outgoing", "incoming"] * 5


@pytest.mark.parametrize("held", [10_000, 0])
def test_pages_of_stored_history_equal_scanned_history(spark, tmp_path, monkeypatch, held):
    monkeypatch.setattr(history, "HELD_FILES", held)
    series = tables.transfer_series(spark.range(1, 5001))
    # one account of many files: every transfer also pays a fee to it
    hub = series.withColumns({"destination_account_id": F.lit("m-hub"), "transfer_id": F.concat("transfer_id", F.lit("h"))})
    every = series.unionByName(hub).withColumn("created_at", F.date_trunc("minute", "created_at").cast("timestamp_ntz"))
    path = str(tmp_path / "history")
    history.write(postings(every), path, files=7)
    pages = history.History(spark, path)
    for account in (*map(tables.series_account, (0, 42, 999)), "m-hub"):
        whole = account_history(every, account, 100).collect()
        before, found = None, []
        while len(found) < len(whole):
            page = pages.page(account, 7, before).collect()
            found += page
            before = (page[-1].created_at, page[-1].transfer_id)
        assert [r.transfer_id for r in found[: len(whole)]] == [r.transfer_id for r in whole]
    assert pages.page("nobody").count() == 0 and pages.files("nobody", 20) == []


def test_a_page_opens_few_files_and_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "ROW_GROUP_BYTES", 64 << 10)
    path = str(tmp_path / "history")
    history.write(postings(tables.transfer_series(spark.range(1, 200_001))), path, files=8)
    pages = history.History(spark, path)
    account = tables.series_account(42)
    (file,) = pages.files(account, 20)
    groups = pq.ParquetFile(file.removeprefix("file://")).metadata
    column = next(i for i in range(groups.num_columns) if groups.schema.column(i).name == "account_id")
    spans = [groups.row_group(n).column(column).statistics for n in range(groups.num_row_groups)]
    opened = sum(s.min <= account <= s.max for s in spans)
    assert len(spans) > 10 and opened <= 2
    # a deep page of an account of many files begins where it must
    hub = tables.transfer_series(spark.range(1, 5001)).withColumn("source_account_id", F.lit("hub"))
    history.write(postings(hub).where("account_id = 'hub'"), str(tmp_path / "hub"), files=8)
    pages = history.History(spark, str(tmp_path / "hub"))
    oldest = pages.manifest.agg(F.min("oldest")).first()[0]
    assert len(pages.files("hub", 20)) <= 2 and len(pages.files("hub", 20, oldest + timedelta(seconds=60))) <= 2


def test_a_refresh_rewrites_only_what_differs(spark, tmp_path):
    keys = {"kind": F.col("k"), "day": F.col("d")}
    store = snapshots.Snapshots(spark, str(tmp_path), keys)
    schema = "k string, d string, n long"
    first = [("a", "1", 1), ("a", "2", 2), ("b", "1", 3), (None, "1", 4), ("b", None, 5), ("b", "1", 3)]
    assert store.refresh(spark.createDataFrame(first, schema)) == 5
    assert rows(store.read()) == sorted(first, key=str)
    old = store.read()
    # one partition of a changes, one goes, one is new; b is out of scope
    fresh = [("a", "1", 1), ("a", "3", 9), ("b", "1", 100)]
    assert store.refresh(spark.createDataFrame(fresh, schema), F.col("kind") == "a") == 1
    now = [("a", "1", 1), ("a", "3", 9), *first[2:]]
    assert rows(store.read()) == sorted(now, key=str)
    assert rows(store.read(1)) == rows(old) == sorted(first, key=str)
    assert store.refresh(spark.createDataFrame(fresh, schema), F.col("kind") == "a") == 0
    assert rows(store.read()) == sorted(now, key=str)
    assert store.refresh(spark.createDataFrame(fresh, schema)) == 1
    assert store.vacuum() == [3] and rows(store.read()) == sorted(fresh, key=str)
    with pytest.raises(AnalysisException):
        store.read(1)


def test_event_refresh_is_rerun_safe(make, tx):
    holders = make("accounts", dict(account_id=11, customer_id=1))
    moves = tx(
        (11, "2026-01-03", "cash_in", "completed", 10),
        (11, "2026-01-02", "cash_in", "completed", 20),
        (11, "2026-01-04", "card_payment", "failed", 1),
        (11, "2026-01-05", "card_payment", "completed", 1),
    )
    log = make(
        "product_events",
        dict(event_id=1, customer_id=1, event_ts=at("2026-01-01"), event_name="signup_completed"),
        dict(event_id=2, customer_id=1, event_ts=at("2025-01-01"), event_name="first_funding"),
    )
    once = events.refreshed_events(log, holders, moves)
    assert [(n, t, v and str(v)) for n, t, v in rows(once, "event_name", "event_ts", "event_value")] == [
        ("first_funding", at("2026-01-02"), "20.00"),
        ("first_transaction", at("2026-01-05"), None),
        ("signup_completed", at("2026-01-01"), None),
    ]
    assert rows(events.refreshed_events(once, holders, moves)) == rows(once)


def read_by(df):
    """Names of the source tables that a plan reads again."""
    return {f.split("/")[-1] for f in df.inputFiles() if SMALL in f}


def test_extracts_join_lineitem_once(spark, monkeypatch):
    written, write = {}, sinks.write_extracts
    monkeypatch.setattr(sinks, "write_extracts", lambda views, folder: (written.update(views), write(views, folder)))
    for name in ("sink_extracts", "src_extracts"):
        written.clear()
        assert registry.named_queries()[name](spark, SMALL).count()
        assert len(written) == 7
        assert not any("lineitem.parquet" in read_by(df) for df in written.values())


def test_a_refresh_joins_lineitem_once(spark, monkeypatch):
    given, refresh = [], snapshots.Snapshots.refresh
    monkeypatch.setattr(
        snapshots.Snapshots, "refresh", lambda self, df, *scope: (given.append(df), refresh(self, df, *scope))[1]
    )
    assert registry.named_queries()["sink_refresh"](spark, SMALL).count()
    assert [read_by(df) for df in given] == [set(), set()]


def test_lifecycle_events_join_customers_once(spark):
    bank = Bank(spark, SMALL)
    found = bank.lifecycle_events
    assert read_by(found) == set()
    assert rows(found) == rows(events.lifecycle_events(bank.customers, bank.kyc_cases, bank.accounts))
