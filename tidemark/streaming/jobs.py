"""Streaming queries; each has a batch twin among the operators.

Rules over single sessions and keys run on keyed state (``stateful``), the activity after a funding is an
interval join of two streams; both take files in any order that their ``delay`` covers. The other
queries are mergeable partial results and take new files in any number and order: every micro-batch is reduced to a partial result (a
minimum, a count, the rows a rule needs) and written under its batch number, so a repeated batch
replaces itself. Partials of one key merge the same way in any order, which happens on reading. No
row is ever late: ``delay`` only says how far event time must have passed a window or a session for
it to be closed in the result. Nothing of them is kept in state stores; partials are merged level by
level (``partials``), because merging merged partials is the same merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import from_micros
from tidemark.functions.money import completed, is_activity, margin, mean_of, revenue
from tidemark.operators.economics import first_fundings as earliest_fundings
from tidemark.operators.ledger import scoped_key
from tidemark.operators.skew import first_per_key
from tidemark.session import run_dir
from tidemark.streaming import partials, stateful

DELAY = "30 minutes"
LEAST_FILES, BATCH_BYTES = 64, 16 << 20  # of a micro-batch; bytes per shuffle partition


def _ignored(progress: dict) -> None:
    """Nobody watches the progress reports."""


def _files_per_batch(spark: SparkSession, path: str) -> int:
    """So many files that a micro-batch is worth a task per shuffle partition.

    A micro-batch has fixed costs per partition; small files in batches of a fixed number would make these
    grow with the number of files times that of partitions.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place)
    wanted = BATCH_BYTES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    files, size = held.getFileCount(), max(held.getLength(), 1)
    return max(LEAST_FILES, min(files, -(-wanted * files // size)))


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New parquet files under a path as a stream, a number per micro-batch that steers only speed.

    The file source wants a folder or a pattern; a pattern equal to the path serves both a
    folder and a single file.
    """
    pattern = f"{path[:-1]}[{path[-1]}]"
    return (
        spark.readStream.schema(spark.read.parquet(path).schema)
        .option("maxFilesPerTrigger", max_files or _files_per_batch(spark, path))
        .parquet(pattern)
    )


def collected(
    stream: DataFrame,
    purpose: str,
    partial: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    watch: Callable[[dict], None] = _ignored,
) -> DataFrame:
    """Process everything available and return the merged partial results of all micro-batches."""
    spark = stream.sparkSession
    folder = run_dir(spark, purpose)
    parts = partials.Partials(spark, f"{folder}/out", merge)

    def put(rows: DataFrame, number: int) -> None:
        parts.put(partial(rows), number)

    with stateful.state_on_disk(spark):
        query = (
            stream.writeStream.foreachBatch(put)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    for progress in query.recentProgress:
        watch(progress)
    return parts.read(partial(spark.createDataFrame([], stream.schema)))


def _closed(partials: DataFrame, delay: str):
    """The event time that everything before is closed: the latest seen, less the delay."""
    (latest,) = partials.agg(F.max("latest")).first()
    return F.lit(latest).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")


# ---- rules over requests -----------------------------------------------------------------------


def unique_requests(
    requests: DataFrame, window_seconds: int, delay: str, watch: Callable[[dict], None] = _ignored
) -> DataFrame:
    """The first request of every scoped key in its retry window; once it has passed, the key is free again."""
    rows = stateful.timed(requests.withColumn("scoped_key", scoped_key()), "scoped_key", "ts", "request_id")
    decided = stateful.gated(rows, 1, window_seconds, delay, sessions=False, watch=watch)
    return decided.where("outcome IN ('passed', 'late')").select(
        F.col("key").alias("scoped_key"), F.col("id").alias("request_id"), (F.col("outcome") == "late").alias("late")
    )


def _session_rows(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    opened = stateful.timed(sessions, "session_id", "created_at", None, "expires_at")
    return opened.unionByName(stateful.timed(requests, "session_id", "ts", "request_id"))


def rate_limited(
    requests: DataFrame,
    sessions: DataFrame,
    limit: int,
    window_seconds: int,
    delay: str,
    watch: Callable[[dict], None] = _ignored,
) -> DataFrame:
    """Pass or reject each request; ``passed`` is NULL outside of its session, ``late`` marks the undecided.

    Both sides are streams: sessions as they are created, and requests.
    """
    decided = stateful.gated(_session_rows(requests, sessions), limit, window_seconds, delay, True, watch)
    outcome = F.col("outcome")
    return decided.where(outcome != "expired").select(
        F.col("key").alias("session_id"),
        F.col("id").alias("request_id"),
        F.when(outcome.isin("passed", "limited"), outcome == "passed").alias("passed"),
        (outcome == "late").alias("late"),
    )


def expired_sessions(
    requests: DataFrame, sessions: DataFrame, delay: str, watch: Callable[[dict], None] = _ignored
) -> DataFrame:
    """Sessions at the moment their lifetime has passed, and the requests turned away outside of one or late.

    A session leaves the state when its timer fires.
    """
    limit = stateful.END  # requests inside a session are not limited here
    decided = stateful.gated(_session_rows(requests, sessions), limit, 60, delay, True, watch)
    return decided.where("outcome IN ('expired', 'refused', 'late')").select(
        F.col("key").alias("session_id"),
        F.col("id").alias("request_id"),
        from_micros("at").alias("at"),
        "outcome",
    )


def request_counts(requests: DataFrame, width: str = "1 minute", delay: str = DELAY) -> DataFrame:
    """Requests and sessions seen per tumbling window, once the window has closed."""

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.window("ts", width).alias("w")).agg(
            F.count("*").alias("requests"),
            F.count_if("opens_session").alias("new_sessions"),
            F.max("ts").alias("latest"),
        )

    def merged(found: DataFrame) -> DataFrame:
        return found.groupBy("w").agg(
            F.sum("requests").alias("requests"),
            F.sum("new_sessions").alias("new_sessions"),
            F.max("latest").alias("latest"),
        )

    found = collected(requests.select("ts", "opens_session"), "counts", counted, merged)
    return found.where(F.col("w.end") <= _closed(found, delay)).select(
        F.col("w.start").alias("window_start"), "requests", "new_sessions"
    )


# ---- rules over transactions -------------------------------------------------------------------


def daily_economics(
    transactions: DataFrame, width: str = "1 day", delay: str = DELAY
) -> DataFrame:
    """Unit economics per day and type of the days that have closed."""
    totals = {
        "transaction_volume_gbp": F.col("amount_gbp"),
        "revenue_gbp": revenue(),
        "processing_cost_gbp": F.col("processing_cost_gbp"),
        "contribution_margin_gbp": margin(),
    }

    def priced(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.window("transaction_ts", width).alias("w"), "transaction_type").agg(
            F.count_if(completed()).alias("completed_transactions"),
            *[F.sum(F.when(completed(), v)).cast("decimal(38,2)").alias(name) for name, v in totals.items()],
            F.max("transaction_ts").alias("latest"),
        )

    def merged(found: DataFrame) -> DataFrame:
        return found.groupBy("w", "transaction_type").agg(
            F.sum("completed_transactions").alias("completed_transactions"),
            *[F.sum(name).alias(name) for name in totals],
            F.max("latest").alias("latest"),
        )

    found = collected(transactions, "daily", priced, merged)
    average = mean_of("contribution_margin_gbp", "completed_transactions", 4)
    return (
        found.where(F.col("w.end") <= _closed(found, delay))
        .withColumn("avg_margin_per_transaction_gbp", average)
        .select(F.col("w.start").alias("day"), "*")
        .drop("w", "latest")
    )


def first_fundings(transactions: DataFrame) -> DataFrame:
    """The first completed cash-in of each account."""

    def earliest(found: DataFrame) -> DataFrame:
        return first_per_key(found, ["account_id"], ["transaction_ts", "transaction_id"], "transaction_id")

    return collected(transactions, "fundings", earliest_fundings, earliest)


def activity_after_funding(
    fundings: DataFrame,
    transactions: DataFrame,
    first_day: int,
    end_day: int,
    delay: str,
    watch: Callable[[dict], None] = _ignored,
) -> DataFrame:
    """Events per account in [first_day, end_day) after its funding, both sides as streams.

    An interval join: a funding stays in state until the watermark has passed its last day, an event until no
    funding it could follow can still come. Pairs are counted per micro-batch as they are found.
    """
    funded = fundings.select(
        F.col("account_id").alias("_account"), F.col("transaction_ts").cast("timestamp").alias("funded_ts")
    ).withWatermark("funded_ts", delay)
    active = (
        transactions.where(is_activity())
        .select("account_id", F.col("transaction_ts").cast("timestamp").alias("at"))
        .withWatermark("at", delay)
    )
    inside = (
        (F.col("account_id") == F.col("_account"))
        & (F.col("at") >= F.col("funded_ts") + F.expr(f"INTERVAL {first_day} DAYS"))
        & (F.col("at") < F.col("funded_ts") + F.expr(f"INTERVAL {end_day} DAYS"))
    )

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("account_id").agg(F.count("*").alias("events"))

    met = active.join(funded, inside).select("account_id")

    def merged(found: DataFrame) -> DataFrame:
        return found.groupBy("account_id").agg(F.sum("events").alias("events"))

    return collected(met, "activity", counted, merged, watch)
