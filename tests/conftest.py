import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.schemas import TABLES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make(spark):
    """Build a table from partial rows: absent columns are NULL, or the declared default."""

    def build(table: str, *rows: dict):
        declared = TABLES[table]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in declared.schema])

        def value(row, field):
            got = row.get(field.name, declared.defaults.get(field.name))
            if isinstance(field.dataType, T.DecimalType) and got is not None:
                return Decimal(str(got))
            return got

        return spark.createDataFrame(
            [tuple(value(r, f) for f in schema) for r in rows], schema
        )

    return build


@pytest.fixture(scope="session")
def tx(make):
    """Transactions numbered from 1: (account, time, type, status, amount, extra columns)."""

    def build(*rows):
        made = []
        for i, (account, ts, kind, status, amount, *extra) in enumerate(rows, 1):
            row = dict(
                transaction_id=i,
                account_id=account,
                transaction_ts=at(ts),
                transaction_type=kind,
                status=status,
                amount_gbp=amount,
            )
            made.append(row | (extra[0] if extra else {}))
        return make("transactions", *made)

    return build


def rows(df, *columns):
    """Rows as sorted tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(df):
    (row,) = df.collect()
    return row.asDict()


def ts_col(text: str):
    return F.lit(text).cast("timestamp_ntz")
