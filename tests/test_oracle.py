"""Every named query against the same query in SQL on an independent engine."""

import duckdb
import pytest

import __spark_entry__
from tests.conftest import SMALL
from tidemark.plans import oracle, registry

SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = registry.named_queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


def _key(row):
    return tuple((value is None, str(value)) for value in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in places) for r in cursor.fetchall()), key=_key)
    assert ours == theirs


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() == 5
