"""Fixed-window request limits, each window opening at the request that starts it.

A session's first window opens when the session is created. A request at least one window
length after the open window's start opens a new one; otherwise it passes while fewer than
``limit`` requests have passed in the open window. Rejected requests are not counted.

A window's start depends on all earlier ones. Sessions of fewer than ``HOT_ROWS`` requests are walked window by
window. For larger ones every request first points to the first request a window later; doubling these
pointers finds the windows that the session really opens in as many joins as the number of windows has
binary digits, and requests are then ranked inside their window, so no session has to fit into a task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import plain_micros
from tidemark.operators.scan import into_ranges, next_values, prefix_sums
from tidemark.operators.skew import HOT_ROWS, hot_keys, mark_first
from tidemark.session import stored

# Ship this module's functions inside the job: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 60
WINDOW_SECONDS = 60


def pass_requests(
    times: np.ndarray, start: int, used: int, width: int, limit: int
) -> tuple[np.ndarray, int, int]:
    """Which of the sorted ``times`` pass, given the open window's start and requests passed.

    Also returns the window left open and the requests passed in it. Works window by window, so
    its cost follows the number of windows rather than requests.
    """
    passed = np.zeros(len(times), dtype=bool)
    lower, upper = 0, int(np.searchsorted(times, start + width, side="left"))
    while True:
        taken = min(upper - lower, max(limit - used, 0))
        passed[lower : lower + taken] = True
        used += taken
        if upper >= len(times):
            return passed, start, used
        start, used, lower = int(times[upper]), 0, upper
        upper = int(np.searchsorted(times, start + width, side="left"))


def _sweep(limit: int, width: int):
    """Walk rows sorted by (session, time, id), carrying the open window from batch to batch."""

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        session, started, used = None, 0, 0
        for pdf in batches:
            ids, times = pdf["session_id"].to_numpy(), pdf["at"].to_numpy()
            opened = pdf["opened"].to_numpy()
            passed = np.empty(len(pdf), dtype=bool)
            edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1), len(pdf)]
            for low, high in zip(edges[:-1], edges[1:]):
                if low == high:
                    continue
                if ids[low] != session:
                    session, started, used = ids[low], int(opened[low]), 0
                passed[low:high], started, used = pass_requests(
                    times[low:high], started, used, width, limit
                )
            yield pdf[["session_id", "request_id"]].assign(passed=passed)

    return sweep


def _window_starts(live: DataFrame, width: int) -> DataFrame:
    """(session_id, request_id) of the requests that open a window; ``live`` has session_id, request_id, at, opened."""
    # a request, or the question which request is the first at some time; questions of an instant come first
    request = live.select("session_id", F.col("at").alias("t"), F.lit(1).alias("kind"), "request_id", F.lit(False).alias("root"))
    asked = live.select("session_id", (F.col("at") + width).alias("t"), F.lit(0).alias("kind"), "request_id", F.lit(False).alias("root"))
    roots = live.groupBy("session_id").agg((F.min("opened") + width).alias("t")).select(
        "session_id", "t", F.lit(0).alias("kind"), F.lit(None).cast(live.schema["request_id"].dataType).alias("request_id"),
        F.lit(True).alias("root"),
    )
    points = request.unionByName(asked).unionByName(roots)
    order = ["t", "kind", "request_id"]
    ranged = into_ranges(points, ["session_id"], order)
    value = F.when(F.col("kind") == 1, F.struct("t", "request_id"))
    found = next_values(ranged, ["session_id"], order, value, "next").where((F.col("kind") == 0) & F.col("next").isNotNull())
    told = stored(found.select("session_id", "request_id", "root", F.col("next.request_id").alias("next")), "pointers")
    keys = ["session_id", "request_id"]
    starts = told.where("root").select("session_id", F.col("next").alias("request_id"))
    jump = told.where("NOT root").drop("root")
    new = stored(starts, "starts")
    every = new
    while True:
        # the known starts are the first 2^k of each session, and a jump is 2^k windows long
        new = stored(every.join(jump, keys).select("session_id", F.col("next").alias("request_id")), "starts")
        if new.isEmpty():
            return every
        every = every.unionByName(new)
        second = jump.select("session_id", F.col("request_id").alias("next"), F.col("next").alias("after"))
        jump = stored(jump.join(second, ["session_id", "next"]).select(*keys, F.col("after").alias("next")), "pointers")


def _ranked_in_windows(live: DataFrame, limit: int, width: int) -> DataFrame:
    """(session_id, request_id, passed) of sessions too large for one walk."""
    keys, order = ["session_id"], ["at", "request_id"]
    opens = _window_starts(live, width).withColumn("opens", F.lit(1).cast("long"))
    marked = live.select(*keys, *order).join(opens, ["session_id", "request_id"], "left")
    ranged = into_ranges(marked, keys, order)
    numbered = prefix_sums(ranged, keys, order, {"_window": F.coalesce("opens", F.lit(0).cast("long"))}, inclusive=True)
    marked = mark_first(numbered, ["session_id", "_window"], order, limit, "request_id", "passed")
    return marked.select("session_id", "request_id", "passed")


def rate_limited(
    requests: DataFrame,
    sessions: DataFrame,
    limit: int = LIMIT,
    window_seconds: int = WINDOW_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(session_id, request_id, passed) for every request of a known session.

    ``passed`` is NULL from the session's ``expires_at`` on: such a request is turned away before
    it could count. The others are sorted into partitions and walked batch by batch, but for sessions of
    ``hot_rows`` requests or more, whose windows are found by doubling.
    """
    width = window_seconds * 1_000_000
    opened = sessions.select(
        "session_id",
        plain_micros("window_start").alias("opened"),
        plain_micros("expires_at").alias("expires"),
    )
    timed = requests.select("session_id", "request_id", plain_micros("ts").alias("at"))
    known = timed.join(opened, "session_id")
    schema = timed.select("session_id", "request_id").schema.add("passed", "boolean")
    alive = F.col("at") < F.col("expires")
    live = known.where(alive)
    # at most one in hot_rows requests is the name of a hot session
    hot = stored(hot_keys(live, "session_id", hot_rows).select("session_id"), "hot")
    any_hot = not hot.isEmpty()
    rest = live.join(F.broadcast(hot), "session_id", "left_anti") if any_hot else live
    # dealt by a hash of its own: a partitioning that the join before already has could be given up with
    # that join when adaptive execution turns it into a broadcast
    dealt = rest.repartition(F.xxhash64("session_id"))
    ordered = dealt.sortWithinPartitions("session_id", "at", "request_id")
    late = known.where(~alive).select(
        "session_id", "request_id", F.lit(None).cast("boolean").alias("passed")
    )
    walked = ordered.mapInPandas(_sweep(limit, width), schema).unionByName(late)
    if not any_hot:
        return walked
    large = live.join(F.broadcast(hot), "session_id", "left_semi")
    return walked.unionByName(_ranked_in_windows(large, limit, width))
