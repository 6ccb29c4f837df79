"""Labels and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shown on the dashboard.
VARIANT_LABELS = {"bonus_10": "£10 bonus", "control": "Control"}
WINDOW_LABELS = {"d30_retention_pct": "D30", "d60_retention_pct": "D60"}
FX_LABEL, NON_FX_LABEL = "FX user", "Non-FX user"


def zero_padded(number: Column, width: int) -> Column:
    """Digits with leading zeros; longer numbers stay whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def title_label(code: Column) -> Column:
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def mapped(code: Column, labels: dict[str, str]) -> Column:
    case = F
    for key, label in labels.items():
        case = case.when(code == key, F.lit(label))
    return case.otherwise(F.lit(None).cast("string"))


def segment_label(used_fx: Column) -> Column:
    return F.when(used_fx, F.lit(FX_LABEL)).otherwise(F.lit(NON_FX_LABEL))


def pounds(value: Column, places: int = 2) -> Column:
    return F.concat(F.lit("£"), F.format_number(value.cast("double"), places))


def pounds_millions(value: Column) -> Column:
    millions = F.round(value.cast("double") / 1_000_000, 1)
    return F.concat(F.lit("£"), F.format_string("%.1f", millions), F.lit("M"))


def percent(value: Column, places: int = 2) -> Column:
    return F.concat(F.format_string(f"%.{places}f", value.cast("double")), F.lit("%"))
