"""Operators that SQL can express, against an independent engine."""

import duckdb
import pytest

from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.01"
SQL = queries.oracle_sql()


def _key(row):
    return tuple((value is None, str(value)) for value in row)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries.named_queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert ours == sorted((tuple(r[i] for i in places) for r in cursor.fetchall()), key=_key)
