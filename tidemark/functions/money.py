"""Money, rate and rounding expressions.

Money stays DECIMAL until it is averaged; sums are therefore exact and independent of row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
SMALL_MONEY = "decimal(12,2)"


def completed() -> Column:
    return F.col("status") == "completed"


def is_funding() -> Column:
    """A completed cash-in; the first one per account is its funding."""
    return (F.col("transaction_type") == "cash_in") & completed()


def is_activity() -> Column:
    """A completed transaction that is not a cash-in."""
    return (F.col("transaction_type") != "cash_in") & completed()


def is_fx() -> Column:
    return (F.col("transaction_type") == "fx_exchange") & completed()


def revenue() -> Column:
    return (
        F.col("fee_revenue_gbp")
        + F.col("interchange_revenue_gbp")
        + F.col("fx_spread_revenue_gbp")
    )


def margin() -> Column:
    return revenue() - F.col("processing_cost_gbp")


def per(total: Column, count: Column, places: int = 2) -> Column:
    """total / count as a rounded double, NULL where there is nothing to divide by.

    Divides as DECIMAL: a quotient such as 2.04125 is no exact double, and rounding one would
    send ties either way. The quotient keeps at least 15 decimals, far more than any tie needs.
    """
    exact = F.try_divide(total.cast("decimal(24,2)"), count.cast("decimal(20,0)"))
    return F.round(exact, places).cast("double")


def pct(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole for counts."""
    return per(part.cast("decimal(22,0)") * 100, whole, places)


def mean(value: Column, places: int = 2) -> Column:
    """Average of the non-NULL values, from an exact sum."""
    return per(F.sum(value), F.count(value), places)


def mean_of(total: str, count: str, places: int = 2) -> Column:
    """Average from a column of totals and one of counts."""
    return per(F.col(total), F.col(count), places)
