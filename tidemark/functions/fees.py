"""Fee schedule, exchange rates and the columns computed from them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.money import SMALL_MONEY, completed


@dataclass(frozen=True)
class Tariff:
    fee: str = "0.00"  # charged once the amount exceeds `fee_above`
    fee_above: str = "0.00"
    interchange_rate: str = "0.0000"
    spread_rate: str = "0.0000"
    cost: str = "0.00"
    cost_rate: str = "0.0000"


# Fixed values of the fee schedule.
TARIFFS = {
    "cash_in": Tariff(cost="0.02"),
    "card_payment": Tariff(interchange_rate="0.0065", cost="0.02", cost_rate="0.0015"),
    "bank_transfer": Tariff(fee="0.25", fee_above="250.00", cost="0.04"),
    "fx_exchange": Tariff(spread_rate="0.0040", cost="0.03"),
    "cash_withdrawal": Tariff(fee="1.00", fee_above="200.00", cost="0.35"),
}
UNCOMPLETED_COST = "0.01"
ACTIVATION_BONUS = "10.00"

# GBP value of one unit of each currency, and the spread in basis points.
RATES_TO_GBP = {"GBP": 1.00, "EUR": 0.86, "USD": 0.79, "CHF": 0.89}
SPREAD_BPS = "40.00"


def _money(value: str) -> Column:
    return F.lit(value).cast(SMALL_MONEY)


def _rate(value: str) -> Column:
    return F.lit(value).cast("decimal(5,4)")


def _by_type(value_of, otherwise: Column) -> Column:
    """One CASE over transaction_type with a branch only where a tariff differs from the rest.

    ``value_of`` gives None for tariffs that have nothing to compute, so most rows cost no
    decimal arithmetic. Types outside the schedule get ``otherwise``.
    """
    values = {name: value_of(tariff) for name, tariff in TARIFFS.items()}
    branches = [(name, value) for name, value in values.items() if value is not None]
    case = reduce(
        lambda c, branch: c.when(F.col("transaction_type") == branch[0], branch[1]), branches, F
    )
    return case.otherwise(otherwise)


def fee_columns(amount: Column | None = None) -> dict[str, Column]:
    """fee, interchange, spread and cost of a transaction; half pennies round away from zero."""
    amount = F.col("amount_gbp") if amount is None else amount
    nothing = _money("0.00")

    def share(rate: str) -> Column | None:
        return F.round(amount * _rate(rate), 2).cast(SMALL_MONEY) if float(rate) else None

    def fee(t: Tariff) -> Column | None:
        if not float(t.fee):
            return None
        return F.when(amount > _money(t.fee_above), _money(t.fee)).otherwise(nothing)

    def cost(t: Tariff) -> Column:
        if not float(t.cost_rate):
            return _money(t.cost)
        return F.round(_money(t.cost) + amount * _rate(t.cost_rate), 2).cast(SMALL_MONEY)

    def if_completed(value_of, untyped: Column, otherwise: Column) -> Column:
        return F.when(completed(), _by_type(value_of, untyped)).otherwise(otherwise)

    return {
        "fee_revenue_gbp": if_completed(fee, nothing, nothing),
        "interchange_revenue_gbp": if_completed(
            lambda t: share(t.interchange_rate), nothing, nothing
        ),
        "fx_spread_revenue_gbp": if_completed(lambda t: share(t.spread_rate), nothing, nothing),
        "processing_cost_gbp": if_completed(
            cost, _money(TARIFFS["cash_in"].cost), _money(UNCOMPLETED_COST)
        ),
    }


def rate_to_gbp(currency: Column) -> Column:
    case = reduce(
        lambda c, item: c.when(currency == item[0], F.lit(item[1])), RATES_TO_GBP.items(), F
    )
    return case.otherwise(F.lit(None).cast("double"))


def quote_columns(amount: Column, source: Column, target: Column) -> dict[str, Column]:
    """Convert through GBP: both sides of the exchange and the rate between them."""
    gbp = amount.cast("double")
    sold = F.try_divide(gbp, rate_to_gbp(source))
    bought = F.try_divide(sold * rate_to_gbp(source), rate_to_gbp(target))
    return {
        "source_amount": F.round(sold, 2).cast("decimal(14,2)"),
        "target_amount": F.round(bought, 2).cast("decimal(14,2)"),
        "quoted_rate": F.round(F.try_divide(bought, sold), 8).cast("decimal(18,8)"),
        "spread_bps": F.lit(SPREAD_BPS).cast("decimal(10,2)"),
    }
