"""Two-proportion test as column arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational Chebyshev fit of erfc published in Numerical Recipes (relative error
# below 1.2e-7 everywhere), highest power first.
ERFC_FIT = [
    0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807,
    -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223,
]
Z_95 = 1.96


def erfc_of_magnitude(x: Column) -> Column:
    """Complementary error function of |x|; Spark has none built in."""
    size = F.abs(x)
    t = 1.0 / (1.0 + 0.5 * size)
    fit = reduce(lambda total, c: total * t + F.lit(c), ERFC_FIT[1:], F.lit(ERFC_FIT[0]))
    return t * F.exp(-size * size + fit)


def two_proportion_columns(
    hits: Column, total: Column, base_hits: Column, base_total: Column
) -> dict[str, Column]:
    """Lift, z (pooled), two-sided p, and the 95 % interval of the lift (unpooled)."""
    rate = F.try_divide(hits.cast("double"), total)
    base = F.try_divide(base_hits.cast("double"), base_total)
    lift = rate - base
    pooled = F.try_divide((hits + base_hits).cast("double"), total + base_total)
    spread = F.sqrt(
        pooled
        * (1.0 - pooled)
        * (F.try_divide(F.lit(1.0), total) + F.try_divide(F.lit(1.0), base_total))
    )
    z = F.try_divide(lift, spread)
    own_spread = F.sqrt(
        F.try_divide(rate * (1.0 - rate), total) + F.try_divide(base * (1.0 - base), base_total)
    )
    return {
        "lift": lift,
        "z_stat": z,
        "p_value": erfc_of_magnitude(z / F.sqrt(F.lit(2.0))),
        "ci_lower": lift - Z_95 * own_spread,
        "ci_upper": lift + Z_95 * own_spread,
    }
