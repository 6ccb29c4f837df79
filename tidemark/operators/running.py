"""Balance after every posting, also for accounts too busy for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ledger import EXACT, over_limit
from tidemark.operators.scan import into_ranges, prefix_sums

ORDER = ("created_at", "transfer_id")


def running_balances(accounts: DataFrame, posted: DataFrame) -> DataFrame:
    """Opening balance plus all postings up to and including each one, in (time, id) order.

    A prefix scan over ranges of sorted postings: no account and no instant has to fit into a task.
    """
    moved = {"_moved": F.col("signed_minor").cast(EXACT)}
    scanned = prefix_sums(into_ranges(posted, ["account_id"], ORDER), ["account_id"], ORDER, moved, inclusive=True)
    opening = accounts.select("account_id", F.col("opening_balance_minor").alias("_opening"))
    balance = (F.col("_opening") + F.col("_moved")).cast(EXACT)
    return _flagged(
        scanned.join(opening, "account_id")
        .withColumn("balance_after_minor", balance)
        .drop("_range", "_opening", "_moved")
    )


def _flagged(running: DataFrame) -> DataFrame:
    after = F.col("balance_after_minor")
    return running.withColumn("overdrawn", after < 0).withColumn("over_limit", over_limit(after))


def overdraft_summary(running: DataFrame) -> DataFrame:
    """Postings and flagged postings per account, and the lowest balance reached."""
    return running.groupBy("account_id").agg(
        F.count("*").alias("postings"),
        F.count_if("overdrawn").alias("overdrawn_postings"),
        F.count_if("over_limit").alias("over_limit_postings"),
        F.min("balance_after_minor").alias("lowest_balance_minor"),
    )
