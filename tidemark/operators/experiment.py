"""A/B readout: arm summaries, significance, break-even economics and the launch decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fees import ACTIVATION_BONUS
from tidemark.functions.money import MONEY, mean, pct
from tidemark.functions.stats import two_proportion_columns
from tidemark.operators.accounts import account_facts
from tidemark.operators.funnel import events_named

ZERO = "0.00"


def charged_facts(
    transactions: DataFrame, accounts: DataFrame, assignments: DataFrame, variant: str = "bonus_10"
) -> DataFrame:
    """Margin and activation bonus per account from one pass over transactions without bonus.

    An account is charged once if it was funded and its customer is in ``variant``.
    """
    treated = assignments.where(F.col("variant") == variant).select("customer_id").distinct()
    owners = accounts.select("account_id", "customer_id").join(
        treated.withColumn("_treated", F.lit(True)), "customer_id", "left"
    )
    charged = F.col("first_funding_ts").isNotNull() & F.col("_treated")
    cost = F.when(charged, F.lit(ACTIVATION_BONUS)).otherwise(ZERO).cast(MONEY)
    facts = account_facts(transactions).select("account_id", "margin_gbp", "first_funding_ts")
    return facts.join(owners, "account_id").select(
        "account_id", "margin_gbp", cost.alias("incentive_gbp")
    )


def _participants(assignments, product_events, accounts, transactions) -> DataFrame:
    """One row per assignment with its activation flag and account economics.

    Every joined side is first reduced to one row per customer, so nothing fans out.
    ``transactions`` may already be reduced to margin_gbp and incentive_gbp per account.
    """
    reduced = "margin_gbp" in transactions.columns
    facts = transactions if reduced else account_facts(transactions)
    activated = (
        events_named(product_events, "first_funding")
        .groupBy("customer_id")
        .agg(F.lit(True).alias("activated"))
    )
    economics = accounts.select("account_id", "customer_id").join(
        facts.select("account_id", "margin_gbp", "incentive_gbp"),
        "account_id",
        "left",
    )
    return (
        assignments.join(activated, "customer_id", "left")
        .join(economics.drop("account_id"), "customer_id", "left")
        .withColumn("activated", F.coalesce("activated", F.lit(False)))
        .withColumn("incentive_gbp", F.coalesce("incentive_gbp", F.lit(ZERO).cast(MONEY)))
    )


def experiment_performance(assignments, product_events, accounts, transactions) -> DataFrame:
    people = _participants(assignments, product_events, accounts, transactions)
    active = F.col("activated")
    before = F.when(active, F.col("margin_gbp"))
    after = F.when(active, F.col("margin_gbp") - F.col("incentive_gbp"))
    return people.groupBy("variant").agg(
        F.count("*").alias("assigned_customers"),
        F.count_if(active).alias("activated_customers"),
        pct(F.count_if(active), F.count("*")).alias("activation_rate_pct"),
        F.sum("incentive_gbp").alias("total_incentive_cost_gbp"),
        mean(before).alias("avg_margin_before_incentive_gbp"),
        mean(after).alias("avg_margin_after_incentive_gbp"),
    )


def arm_summary(
    assignments, product_events, accounts, transactions, by: Sequence[str] = ()
) -> DataFrame:
    """Unrounded figures per arm, optionally per experiment or segment column of assignments."""
    people = _participants(assignments, product_events, accounts, transactions)
    margin = F.when(F.col("activated"), F.col("margin_gbp"))
    average = F.try_divide(F.sum(margin).cast("double"), F.count(margin))
    return people.groupBy(*by, "variant").agg(
        F.count("*").alias("assigned_customers"),
        F.count_if("activated").alias("activated_customers"),
        F.sum("incentive_gbp").alias("total_incentive_cost_gbp"),
        F.coalesce(average, F.lit(0.0)).alias("avg_margin_before_incentive_gbp"),
    )


def readout(
    arms: DataFrame,
    by: Sequence[str] = (),
    treatment: str = "bonus_10",
    control: str = "control",
) -> DataFrame:
    """Significance and break-even economics of ``treatment`` against ``control``.

    Arms are laid side by side with one conditional aggregate, so any number of experiments or
    segments is read out at once.
    """

    def arm(name: str, column: str):
        return F.max(F.when(F.col("variant") == name, F.col(column)))

    sides = arms.groupBy(*by).agg(
        arm(treatment, "activated_customers").alias("t_hits"),
        arm(treatment, "assigned_customers").alias("t_all"),
        arm(control, "activated_customers").alias("c_hits"),
        arm(control, "assigned_customers").alias("c_all"),
        arm(treatment, "total_incentive_cost_gbp").cast("double").alias("incentive_cost_gbp"),
        arm(control, "avg_margin_before_incentive_gbp").alias("control_margin_gbp"),
    )
    tested = sides.select(
        "*",
        F.try_divide(F.col("t_hits").cast("double"), "t_all").alias("treatment_rate"),
        F.try_divide(F.col("c_hits").cast("double"), "c_all").alias("control_rate"),
        *[
            value.alias(name)
            for name, value in two_proportion_columns(
                F.col("t_hits"), F.col("t_all"), F.col("c_hits"), F.col("c_all")
            ).items()
        ],
    )
    break_even = F.when(
        F.col("incremental_activations") > 0,
        F.col("incentive_cost_gbp") / F.col("incremental_activations"),
    ).otherwise(F.lit(float("inf")))
    payback = F.when(
        F.col("break_even_margin_gbp") > 0,
        F.col("control_margin_gbp") / F.col("break_even_margin_gbp") * 100,
    ).otherwise(F.lit(0.0))
    significant = (F.col("p_value") < 0.05) & (F.col("lift") > 0)
    return (
        tested.withColumn("relative_lift", F.try_divide("lift", "control_rate"))
        .withColumn("incremental_activations", F.col("lift") * F.col("t_all"))
        .withColumn("break_even_margin_gbp", break_even)
        .withColumn("payback_pct", payback)
        .withColumn("significant", F.coalesce(significant, F.lit(False)))
        .withColumn("launch", F.col("control_margin_gbp") >= F.col("break_even_margin_gbp"))
        .drop("t_hits", "t_all", "c_hits", "c_all")
    )


TEST_COLUMNS = ["lift", "z_stat", "p_value", "ci_lower", "ci_upper"]
ECONOMICS_COLUMNS = [
    "treatment_rate",
    "control_rate",
    "relative_lift",
    "incremental_activations",
    "incentive_cost_gbp",
    "break_even_margin_gbp",
    "control_margin_gbp",
    "payback_pct",
]
DECISION_COLUMNS = ["significant", "launch"]
