"""Constraint checks and reconciliations; every check yields one row.

Result columns: check_name, table_name, violations, passed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import TABLES, Table


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        "check_name",
        "table_name",
        F.col("violations").cast("bigint"),
        (F.col("violations") == 0).alias("passed"),
    )


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_checks(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Count the rows breaking each rule; all rules of a table share one scan and aggregate."""
    names = list(rules)
    counted = df.agg(*[F.count_if(rules[n]).alias(f"c{i}") for i, n in enumerate(names)])
    pairs = [
        F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations"))
        for i, n in enumerate(names)
    ]
    return _finish(
        counted.select(F.inline(F.array(*pairs))).withColumn("table_name", F.lit(table))
    )


def duplicate_keys(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Number of key values held by more than one row; rows with a NULL part are exempt."""
    repeated = (
        df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n"))
    ).agg(F.count_if(F.col("n") > 1).alias("violations"))
    return _finish(
        repeated.select(
            F.lit("unique:" + ",".join(columns)).alias("check_name"),
            F.lit(table).alias("table_name"),
            "violations",
        )
    )


def orphans(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows whose key has no parent. Keys are counted first, so a busy key is one row."""
    keys = child.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_column).alias(column))
    missing = keys.join(parents, column, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
    )
    return _finish(
        missing.select(
            F.lit(f"foreign_key:{column}").alias("check_name"),
            F.lit(table).alias("table_name"),
            "violations",
        )
    )


def _null_rules(t: Table) -> dict[str, Column]:
    return {f"not_null:{c}": F.col(c).isNull() for c in t.required}


def _domain_rules(t: Table, domains: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    return {f"domain:{c}": ~F.col(c).isin(*domains.get(c, allowed)) for c, allowed in t.domains.items()}


def _range_rules(t: Table) -> dict[str, Column]:
    def outside(column: str, low, high) -> Column:
        tests = []
        if low is not None:
            tests.append(F.col(column) < low)
        if high is not None:
            tests.append(F.col(column) > high)
        return reduce(lambda a, b: a | b, tests)

    rules = {f"range:{c}": outside(c, *bounds) for c, bounds in t.ranges.items()}
    rules |= {
        f"length:{c}": ~F.length(c).between(low, high) for c, (low, high) in t.lengths.items()
    }
    return rules


def _cross_rules(t: Table) -> dict[str, Column]:
    return {f"differs:{a},{b}": F.col(a) == F.col(b) for a, b in t.differs}


def _checked(tables: Mapping[str, DataFrame], rules_of: Callable[[Table], dict[str, Column]]):
    parts = []
    for name, df in tables.items():
        rules = rules_of(TABLES[name])
        if rules:
            parts.append(row_checks(df, name, rules))
    return _stack(parts)


def check_unique(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in tables.items():
        t = TABLES[name]
        parts += [duplicate_keys(df, name, columns) for columns in (t.key, *t.unique)]
    return _stack(parts)


def check_not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _checked(tables, _null_rules)


def check_domains(
    tables: Mapping[str, DataFrame], domains: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """``domains`` replaces the declared domain of a column, by column name."""
    return _checked(tables, lambda t: _domain_rules(t, domains or {}))


def check_ranges(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _checked(tables, _range_rules)


def check_differs(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _checked(tables, _cross_rules)


def check_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        orphans(df, name, column, tables[parent], parent_column)
        for name, df in tables.items()
        for column, (parent, parent_column) in TABLES[name].parents.items()
        if parent in tables
    ]
    return _stack(parts)


def fill_defaults(df: DataFrame, table: str) -> DataFrame:
    """Give NULL or missing columns the declared default of the table."""
    t = TABLES[table]
    types = {f.name: f.dataType for f in t.schema}
    filled = {}
    for column, value in t.defaults.items():
        default = F.lit(value).cast(types[column])
        filled[column] = F.coalesce(column, default) if column in df.columns else default
    return df.withColumns(filled) if filled else df


# ---- validation queries ------------------------------------------------------------------


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return _stack(parts).orderBy("table_name")


def frequency(df: DataFrame, column: str, count: str, by_count: bool = True) -> DataFrame:
    counted = df.groupBy(column).agg(F.count("*").alias(count))
    return counted.orderBy(F.desc(count), column) if by_count else counted.orderBy(column)


# ---- contracts between the published extracts -------------------------------------------------

TOLERANCE = 0.01


def _figures(df: DataFrame, view: str, **figures: Column) -> DataFrame:
    """Named totals of one extract as (name, value) rows."""
    totals = df.agg(*[f.cast("double").alias(n) for n, f in figures.items()])
    pairs = [
        F.struct(F.lit(f"{view}.{n}").alias("name"), F.col(n).alias("value")) for n in figures
    ]
    return totals.select(F.inline(F.array(*pairs)))


def _off(a: Column, b: Column) -> Column:
    """Rows where two figures differ by more than a rounding step."""
    return F.count_if(F.abs(a.cast("double") - b.cast("double")) > TOLERANCE + 1e-9)


def check_contracts(views: Mapping[str, DataFrame], bonus: float = 10.0) -> DataFrame:
    """Extracts are non-empty, agree with each other and with their own ratios.

    Each extract is reduced to a few named totals, the totals are laid side by side by one
    aggregate, and every contract is an expression over that single row.
    """
    c = F.col

    def ratio(part: str, whole: str, places: int = 2) -> Column:
        return F.round(F.try_divide(c(part).cast("double") * 100, c(whole)), places)

    kpis = {name: F.max(name) for name in views["kpis"].columns}
    bonus_arm, control_arm = c("variant") == "bonus_10", c("variant") == "control"
    cost, assigned = c("total_incentive_cost_gbp"), c("assigned_customers")
    economics_margin = c("revenue_gbp") - c("processing_cost_gbp")
    per_funded = F.try_divide(c("acquisition_spend_gbp").cast("double"), c("funded_customers"))

    def outside_pct(column: str) -> Column:
        return F.count_if(~c(column).between(0, 100))

    every = F.count("*")
    parts = [
        _figures(views["kpis"], "kpis", rows=every, **kpis),
        _figures(
            views["channel_performance"],
            "channels",
            rows=every,
            signups=F.sum("signups"),
            funded=F.sum("funded_customers"),
            bad_pct=_off(ratio("funded_customers", "signups"), c("signup_to_funding_pct")),
            bad_cost=_off(F.round(per_funded, 2), c("cost_per_funded_customer_gbp")),
        ),
        _figures(
            views["transaction_economics"],
            "economics",
            rows=every,
            margin=F.sum("contribution_margin_gbp"),
            volume=F.sum("transaction_volume_gbp"),
            bad_margin=_off(economics_margin, c("contribution_margin_gbp")),
        ),
        _figures(
            views["experiment_performance"],
            "experiment",
            rows=every,
            assigned=F.sum(assigned),
            bonus_arms=F.count_if(bonus_arm),
            control_arms=F.count_if(control_arm),
            control_cost=F.sum(F.when(control_arm, cost)),
            bonus_cost=F.sum(F.when(bonus_arm, cost)),
            bonus_due=F.sum(F.when(bonus_arm, c("activated_customers") * bonus)),
        ),
        _figures(
            views["retention_cohorts"],
            "retention",
            rows=every,
            outside=outside_pct("d30_retention_pct") + outside_pct("d60_retention_pct"),
            bad_pct=_off(ratio("retained_d30", "funded_customers"), c("d30_retention_pct")),
        ),
        _figures(
            views["fx_customer_segments"], "segments", rows=every, customers=F.sum("customers")
        ),
        _figures(views["fx_retention"], "fx_retention", rows=every),
    ]
    figures = _stack(parts)

    def f(name: str) -> Column:
        return F.max(F.when(c("name") == name, c("value")))

    def same(a: Column, b: Column, slack: float = 0.0) -> Column:
        return F.abs(a - b) <= slack + 1e-9

    extracts = {
        "kpis": "kpis",
        "channel_performance": "channels",
        "transaction_economics": "economics",
        "experiment_performance": "experiment",
        "retention_cohorts": "retention",
        "fx_customer_segments": "segments",
        "fx_retention": "fx_retention",
    }
    signups, funded = f("kpis.total_signups"), f("kpis.funded_customers")
    contracts: dict[tuple[str, str], Column] = {
        ("non_empty", extract): f(f"{short}.rows") > 0 for extract, short in extracts.items()
    }
    contracts |= {
        ("funnel_monotone", "kpis"): (signups >= f("kpis.kyc_approved"))
        & (f("kpis.kyc_approved") >= funded)
        & (funded >= f("kpis.transacting_customers") - 10),
        ("approved_equals_accounts", "kpis"): same(
            f("kpis.kyc_approved"), f("kpis.accounts_opened")
        ),
        ("signups_reconcile", "channel_performance"): same(f("channels.signups"), signups),
        ("funded_reconcile", "channel_performance"): same(f("channels.funded"), funded),
        ("conversion_recomputes", "channel_performance"): f("channels.bad_pct") == 0,
        ("cost_recomputes", "channel_performance"): f("channels.bad_cost") == 0,
        ("margin_reconciles", "transaction_economics"): same(
            f("economics.margin"), f("kpis.total_contribution_margin_gbp"), TOLERANCE
        ),
        ("volume_reconciles", "transaction_economics"): same(
            f("economics.volume"), f("kpis.completed_transaction_volume_gbp"), TOLERANCE
        ),
        ("margin_recomputes", "transaction_economics"): f("economics.bad_margin") == 0,
        ("arms_cover_customers", "experiment_performance"): same(
            f("experiment.assigned"), signups
        ),
        ("arms_are_known", "experiment_performance"): (f("experiment.rows") == 2)
        & (f("experiment.bonus_arms") == 1)
        & (f("experiment.control_arms") == 1),
        ("control_costs_nothing", "experiment_performance"): f("experiment.control_cost") == 0,
        ("bonus_per_activation", "experiment_performance"): same(
            f("experiment.bonus_cost"), f("experiment.bonus_due")
        ),
        ("rates_are_percentages", "retention_cohorts"): f("retention.outside") == 0,
        ("rate_recomputes", "retention_cohorts"): f("retention.bad_pct") == 0,
        ("segments_partition_funded", "fx_customer_segments"): same(
            f("segments.customers"), funded
        ),
    }
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(view).alias("table_name"),
            F.when(test, 0).otherwise(1).alias("violations"),
        )
        for (check, view), test in contracts.items()
    ]
    return _finish(figures.agg(F.array(*rows).alias("rows")).select(F.inline("rows")))
