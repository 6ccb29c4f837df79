"""Wall-clock time (TIMESTAMP_NTZ) as numbers, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def plain_micros(column: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, {column})")


def from_micros(column: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, {column}, {EPOCH})")
