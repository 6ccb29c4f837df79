"""Sessions, rate limits and retry windows as keyed state with event-time timers.

A row waits in state until the watermark has passed it and is then decided in event-time order, so
files may come in any order that ``delay`` covers. State of a key ends with its session or window: a timer
clears it, and what is left is bounded by the rows of the last ``delay`` and by the sessions alive. A row that
comes after the watermark passed it is never dropped in silence: it leaves with the outcome ``late``.

State is kept by buckets of keys (``BUCKETS`` per shuffle partition, by hash), because a call of the processor and
of its state costs about a millisecond, whatever it carries: a bucket's rows come, wait and are decided together, each
key by itself. Buckets are spread over a few state partitions per core, because every micro-batch opens, commits and
uploads the store of each partition. Both numbers are fixed for a checkpoint.

The watermark is taken from a column of its own that the state operator does not see, because rows behind
the watermark of a visible column are removed before the operator gets them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import groupby

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.clock import plain_micros
from tidemark.session import run_dir

# Ship this module's functions inside the job: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DECISION = "key string, id long, at long, outcome string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITIONS = "spark.sql.shuffle.partitions"
END = 4_000_000_000_000_000  # microseconds: after every event
BUCKETS = 64
STORES_PER_CORE = 2


class Gate(StatefulProcessor):
    """Decide a bucket's rows, key by key: ``passed``, ``limited``, ``refused`` (no live session), ``late``; and ``expired``.

    A session opens with a row that ``opens`` it, and ends at ``ends``; requests outside of one are refused. With
    ``sessions`` false, a request outside of a window opens one that ends after ``width``. Inside, at most
    ``limit`` requests pass per window; a request at least ``width`` after the window's start opens the next.
    """

    def __init__(self, limit: int, width: int, sessions: bool) -> None:
        self.limit, self.width, self.sessions = limit, width, sessions

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # an element holds rows side by side, an array per column
        self.waiting = handle.getListState(
            "waiting", "key array<string>, at array<long>, opens array<boolean>, id array<long>, ends array<long>"
        )
        self.open = handle.getValueState("open", "key array<string>, start array<long>, used array<long>, ends array<long>")
        self.next = handle.getValueState("next", "at long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        first = None
        for pdf in rows:
            pdf = pdf[pdf["at"].notna()]
            late = pdf["at"] < passed
            if late.any():
                yield _decisions([(k, i, at, "late") for k, i, at in _columns(pdf[late], "key", "id", "at")])
            kept = [
                (k, int(at), bool(opens), None if pd.isna(i) else int(i), END if pd.isna(ends) else int(ends))
                for k, at, opens, i, ends in _columns(pdf[~late], "key", "at", "opens", "id", "ends")
            ]
            if kept:
                self.waiting.appendValue(_packed(kept))
                least = min(row[1] for row in kept)
                first = least if first is None else min(first, least)
        if first is not None and not (self.next.exists() and self.next.get()[0] <= first):
            self._wake(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.next.exists() or self.next.get()[0] > passed:
            return  # another timer of this bucket has done the work
        rows = [row for held in self.waiting.get() for row in zip(*held, strict=True)] if self.waiting.exists() else []
        due = sorted((r for r in rows if r[1] < passed), key=lambda r: (r[0], r[1], not r[2], r[3] or 0))
        rest = [r for r in rows if r[1] >= passed]
        if due and rest:
            self.waiting.put([_packed(rest)])
        elif due:
            self.waiting.clear()
        was = {k: tuple(now) for k, *now in zip(*self.open.get(), strict=True)} if self.open.exists() else {}
        open_now, out = dict(was), []
        for k, own in groupby(due, key=lambda r: r[0]):
            open_now[k], found = self._decide(open_now.get(k), [r[1:] for r in own])
            out += [(k, *f) for f in found]
        for k, now in open_now.items():
            if now and now[2] <= passed:
                out.append((k, None, now[2], "expired"))
                open_now[k] = None
        left = [(k, *now) for k, now in open_now.items() if now]
        if left:
            self.open.update(_packed(left))
        elif was:
            self.open.clear()
        later = [r[1] for r in rest] + [ends for *_, ends in left]
        if later:
            self._wake(min(later))
        else:
            self.next.clear()
        if out:
            yield _decisions(out)

    def _wake(self, at: int) -> None:
        """Wake once the watermark has passed an instant."""
        self.next.update((at,))
        self.handle.registerTimer(at // 1000 + 1)

    def _decide(self, now: tuple | None, due: list[tuple]) -> tuple[tuple | None, list[tuple]]:
        out = []
        for at, opens, i, ends in due:
            if now and at >= now[2]:
                out.append((None, now[2], "expired"))
                now = None
            if opens:
                now = now or (at, 0, ends)
                continue
            if not now:
                if self.sessions:
                    out.append((i, at, "refused"))
                    continue
                now = (at, 0, at + self.width)
            start, used, ends = now
            if at - start >= self.width:
                start, used = at, 0
            out.append((i, at, "passed" if used < self.limit else "limited"))
            now = (start, min(used + 1, self.limit), ends)
        return now, out


def _columns(pdf: pd.DataFrame, *names: str) -> Iterator[tuple]:
    return zip(*(pdf[name].tolist() for name in names), strict=True)


def _packed(rows: list[tuple]) -> tuple:
    return tuple(list(column) for column in zip(*rows, strict=True))


def _decisions(rows: list[tuple]) -> pd.DataFrame:
    keys, ids, ats, outcomes = zip(*rows, strict=True)
    return pd.DataFrame(
        {
            "key": pd.Series(keys, dtype=object),
            "id": pd.array([None if pd.isna(i) else int(i) for i in ids], dtype="Int64"),
            "at": pd.Series(ats, dtype="int64"),
            "outcome": pd.Series(outcomes, dtype=object),
        }
    )


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """Queries started inside keep a setting of the session that is put back afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def state_on_disk(spark: SparkSession):
    """State stores of the queries started inside keep their state in RocksDB, not on the heap."""
    return _setting(spark, PROVIDER, ROCKSDB)


def timed(rows: DataFrame, key: str, at: str, row_id: str | None, ends: str | None = None) -> DataFrame:
    """Rows for the gate: requests, or openings of sessions that end at ``ends`` (NULL: never)."""
    return rows.select(
        F.col(key).cast("string").alias("key"),
        plain_micros(at).alias("at"),
        F.lit(ends is not None).alias("opens"),
        (F.lit(None) if row_id is None else F.col(row_id)).cast("long").alias("id"),
        (F.lit(None) if ends is None else plain_micros(ends)).cast("long").alias("ends"),
        F.timestamp_micros(plain_micros(at)).alias("clock"),
    )


def gated(
    rows: DataFrame,
    limit: int,
    width_seconds: int,
    delay: str,
    sessions: bool,
    watch: Callable[[dict], None] = lambda progress: None,
) -> DataFrame:
    """Decisions (key, id, at, outcome) on a stream of ``timed`` rows, processed to its end.

    After everything available a mark later than all events closes the stream, so waiting rows are decided and
    open sessions expire. ``watch`` gets the progress reports, with the number of rows in state.
    """
    spark = rows.sparkSession
    folder = run_dir(spark, "gated")
    marks = f"{folder}/marks"
    spark.createDataFrame([], rows.schema).write.parquet(marks)
    stream = rows.unionByName(spark.readStream.schema(rows.schema).parquet(marks))
    shuffled = int(spark.conf.get(PARTITIONS))
    buckets = BUCKETS * shuffled
    stores = min(shuffled, STORES_PER_CORE * spark.sparkContext.defaultParallelism)
    decided = (
        stream.withWatermark("clock", delay)
        .drop("clock")
        .withColumn("key", F.coalesce("key", F.lit("")))
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=Gate(limit, width_seconds * 1_000_000, sessions),
            outputStructType=DECISION,
            outputMode="append",
            timeMode="eventTime",
        )
    )

    def run() -> None:
        with state_on_disk(spark), _setting(spark, PARTITIONS, str(stores)):
            query = (
                decided.writeStream.format("parquet")
                .option("path", f"{folder}/out")
                .option("checkpointLocation", f"{folder}/checkpoint")
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        for progress in query.recentProgress:
            watch(progress)

    run()
    mark = spark.range(1).select(
        *[(F.timestamp_micros(F.lit(END)) if c == "clock" else F.lit(None).cast(t)).alias(c) for c, t in rows.dtypes]
    )
    mark.write.mode("append").parquet(marks)
    run()
    return spark.read.schema(DECISION).parquet(f"{folder}/out")
