"""Transfers settled against live balances, without an order that one task has to keep.

A request is booked if its key is free, its session has quota left, its source can pay and its destination can
take the amount, each after all earlier bookings. A service decides one request after the other;
here all requests are decided in rounds. What is decided so far bounds every balance, quota and key from
below and above: open requests may or may not be booked. A request that the bounds decide is booked or
refused, and the next round knows more. The earliest open request of a session is always decided, so
rounds end; in practice each decides a good part of the rest.

Per round, bounds come from prefix scans over ranges of an account's or a session's requests, fixed once, so
no account or session has to fit into a task. Decided flows are folded into the open rows, so a round
reads only open requests and the bookings of the round before. When no session has more than ``TAIL`` of
them left, each session's rest is walked in order in one task.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.operators.ledger import EXACT, TRANSFER_FIELDS, TRANSFERS_PER_SESSION, scoped_key
from tidemark.operators.scan import into_ranges, prefix_sums
from tidemark.operators.skew import ranked
from tidemark.schemas import MAX_BALANCE_MINOR
from tidemark.session import stored

# Ship this module's functions inside the job: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TAIL = 1_000
#: Bookings that a session starts from; requests without a session have no quota to reach.
NO_QUOTA = -(1 << 62)
SESSION = "_session"
KEY = [SESSION, "idempotency_key"]
ORDER = ["ts", "request_id"]
SIDES = {"source": -1, "destination": 1}
STATE = [
    "request_id", *KEY, "source_account_id", "destination_account_id", "amount_minor", "ts", "_session_range",
    "source_range", "destination_range", "source_base", "destination_base", "_used",
]


# ---- which requests are booked -----------------------------------------------------------------


def _open_requests(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Requests between two accounts of their own session, with the openings and the ranges of both scans."""
    # rows without a session share one, which no session is named like
    session = F.coalesce(F.concat(F.lit(":"), "session_id"), F.lit("")).alias(SESSION)
    held = accounts.select(
        "account_id", session.alias("_owner"), F.col("opening_balance_minor").cast(EXACT).alias("_opening")
    )
    rows = requests.select("request_id", session, "idempotency_key", *TRANSFER_FIELDS[:3], "ts")
    for side in SIDES:
        found = held.withColumnsRenamed({"account_id": f"{side}_account_id", "_opening": f"{side}_base"})
        rows = rows.join(found, f"{side}_account_id").where(F.col(SESSION) == F.col("_owner")).drop("_owner")
    rows = into_ranges(rows, [SESSION], ORDER, "_session_range")
    legs = into_ranges(_legs(rows).select("account_id", "side", *ORDER), ["account_id"], ORDER)
    ranges = legs.groupBy("request_id").agg(
        *[F.max(F.when(F.col("side") == side, F.col("_range"))).alias(f"{side}_range") for side in SIDES]
    )
    used = F.when(F.col(SESSION) == "", NO_QUOTA).otherwise(0).cast("long")
    return stored(rows.join(ranges, "request_id").withColumn("_used", used).select(*STATE), "open")


def _legs(rows: DataFrame, *carry: str) -> DataFrame:
    """Two rows per request, one for each account."""

    def leg(side: str, sign: int):
        parts = [F.col(f"{side}_account_id").alias("account_id"), F.lit(side).alias("side")]
        parts.append((F.lit(sign) * F.col("amount_minor")).cast(EXACT).alias("signed_minor"))
        if f"{side}_range" in rows.columns:
            parts.append(F.col(f"{side}_range").alias("_range"))
        return F.struct(*parts)

    return rows.select(*ORDER, *carry, F.inline(F.array(*[leg(s, n) for s, n in SIDES.items()])))


def _decided(state: DataFrame, limit: int | None, balance_limit: int) -> DataFrame:
    """Open rows with what all known bookings made of their bases, and ``booked`` where the bounds decide it."""
    fresh, flow = F.col("_fresh"), F.col("signed_minor")
    sums = {
        "moved": F.when(fresh, flow),
        "out": F.when(~fresh & (flow < 0), -flow),
        "into": F.when(~fresh & (flow > 0), flow),
    }
    legs = prefix_sums(_legs(state, "_fresh"), ["account_id"], ORDER, sums).where(~fresh)
    side = lambda s, name: F.max(F.when(F.col("side") == s, F.col(name))).alias(f"{s}_{name}")
    bounds = legs.groupBy("request_id").agg(*[side(s, name) for s in SIDES for name in sums])
    at = F.struct(*ORDER)
    keys = state.groupBy(*KEY).agg(
        F.max(fresh).alias("_taken"), F.min(F.when(~fresh, at)).alias("_first")
    )
    if limit is not None:
        count = lambda which: which.cast("int").cast("long")
        state = prefix_sums(
            state, [SESSION], ORDER, {"_more": count(fresh), "_maybe": count(~fresh)}, name="_session_range"
        ).withColumn("_used", F.col("_used") + F.col("_more"))
    base = {s: (F.col(f"{s}_base") + F.col(f"{s}_moved")).cast(EXACT) for s in SIDES}
    amount = F.col("amount_minor")
    source, target = F.col("source_base"), F.col("destination_base")
    refused = (
        F.col("_taken")
        | (source + F.col("source_into") < amount)
        | (target - F.col("destination_out") + amount > balance_limit)
    )
    certain = (
        (F.col("_first") == at)
        & (source - F.col("source_out") >= amount)
        & (target + F.col("destination_into") + amount <= balance_limit)
    )
    if limit is not None:
        refused |= F.col("_used") >= limit
        certain &= F.col("_used") + F.col("_maybe") < limit
    return (
        state.where(~fresh)
        .join(bounds, "request_id")
        .join(keys, KEY)
        .withColumns({f"{s}_base": column for s, column in base.items()})
        .withColumn("booked", F.when(refused, False).when(certain, True))
        .select(*STATE, "booked")
    )


def _walk(limit: int | None, balance_limit: int):
    """Decide the few open rows of one session in order, between its known bookings."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ORDER)
        moved: dict = {}
        taken: set = set()
        used, booked = 0, []
        columns = [
            "idempotency_key", "source_account_id", "destination_account_id", "amount_minor", "source_base",
            "destination_base", "_used", "_fresh",
        ]
        for key, source, target, amount, has, holds, before, fresh in pdf[columns].itertuples(index=False):
            can = (
                key not in taken
                and (limit is None or int(before) + used < limit)
                and int(has) + moved.get(source, 0) >= amount
                and int(holds) + moved.get(target, 0) + amount <= balance_limit
            )
            if fresh or can:
                moved[source] = moved.get(source, 0) - int(amount)
                moved[target] = moved.get(target, 0) + int(amount)
                taken.add(key)
                used += 1
            booked.append(bool(fresh or can))
        return pdf[["request_id"]].assign(booked=booked)[~pdf["_fresh"].to_numpy()]

    return walk


def settle(
    requests: DataFrame,
    accounts: DataFrame,
    limit: int | None = TRANSFERS_PER_SESSION,
    balance_limit: int = MAX_BALANCE_MINOR,
    tail: int = TAIL,
) -> DataFrame:
    """Per valid request between own accounts: ``booked`` and the ``round`` that decided it (from 1).

    ``accounts`` holds account_id, session_id and opening_balance_minor. Without ``limit`` sessions have no quota.
    """
    state = _open_requests(requests, accounts).withColumn("_fresh", F.lit(False))
    kind = state.select("request_id").schema.add("booked", "boolean")
    decided, number = [], 0
    while True:
        number += 1
        many = state.groupBy(SESSION).count().agg(F.max("count")).first()[0] or 0
        if many <= tail:
            # the bases of open rows lack the bookings of the last round, which the walk applies in order
            walk = _walk(limit, balance_limit)
            rest = state.groupBy(SESSION).applyInPandas(walk, kind)
            decided.append(rest.withColumn("round", F.lit(number)))
            break
        found = stored(_decided(state, limit, balance_limit), "round")
        told = found.where(F.col("booked").isNotNull())
        decided.append(told.select("request_id", "booked", F.lit(number).alias("round")))
        left = found.where(F.coalesce("booked", F.lit(True)))
        state = left.withColumn("_fresh", F.col("booked").isNotNull()).drop("booked")
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return stored(out, "settled")


# ---- outcomes ----------------------------------------------------------------------------------


def settlement(
    requests: DataFrame,
    sessions: DataFrame,
    accounts: DataFrame,
    limit: int = TRANSFERS_PER_SESSION,
    balance_limit: int = MAX_BALANCE_MINOR,
    tail: int = TAIL,
) -> DataFrame:
    """Status and code of each raw transfer request, balances included.

    In the order a service decides: 401 without a live session, 422 for a broken rule (``code`` names it), 200 or
    409 ``idempotency_conflict`` for a booked key with the same or other fields, 429 once the session has
    ``limit`` transfers, 404 unless both accounts are the session's own, 409 ``insufficient_funds`` or
    ``balance_limit`` where the balances of that moment refuse it, else 201. A refused request reserves nothing.
    """
    checked = ledger.checked_requests(requests, sessions)
    valid = checked.where(F.col("_live") & F.col("reason").isNull())
    settled = settle(valid, accounts, limit, balance_limit, tail).withColumnRenamed("request_id", "_id")
    at = F.struct("ts", "request_id")
    bookings = valid.join(settled.where("booked"), F.col("request_id") == F.col("_id"))
    stands = stored(bookings.select("request_id", "session_id", "idempotency_key", *TRANSFER_FIELDS, "ts"), "booked")
    booked = stands.select(
        scoped_key().alias("_key"), at.alias("_at"), F.struct(*TRANSFER_FIELDS).alias("_fields")
    )
    named = stands.where(F.col("session_id").isNotNull())
    full = (
        ranked(named, ["session_id"], [F.col(c) for c in ORDER], limit, "request_id")
        .where(F.col("rank") == limit)
        .select("session_id", at.alias("_full"))
    )
    refused = valid.join(settled.where("NOT booked"), F.col("request_id") == F.col("_id"))
    poor = _without_funds(stands, refused, accounts).select(F.col("request_id").alias("_poor"))
    own = settled.select("_id")
    status = (
        F.when(~F.col("_live"), 401)
        .when(F.col("reason").isNotNull(), 422)
        .when(at == F.col("_at"), 201)
        .when((at > F.col("_at")) & (F.struct(*TRANSFER_FIELDS) == F.col("_fields")), 200)
        .when(at > F.col("_at"), 409)
        .when(at > F.col("_full"), 429)
        .when(F.col("_id").isNull(), 404)
        .otherwise(409)
    )
    code = (
        F.when(F.col("status_code") == 401, "session_expired")
        .when(F.col("status_code") == 422, F.col("reason"))
        .when(F.col("status_code") == 429, "transfer_limit")
        .when(F.col("status_code") == 404, "account_not_found")
        .when((F.col("status_code") == 409) & (at > F.col("_at")), "idempotency_conflict")
        .when((F.col("status_code") == 409) & F.col("_poor").isNotNull(), "insufficient_funds")
        .when(F.col("status_code") == 409, "balance_limit")
    )
    return (
        checked.withColumn("_key", scoped_key())
        .join(booked, "_key", "left")
        .join(full, "session_id", "left")
        .join(own, F.col("request_id") == F.col("_id"), "left")
        .join(poor, F.col("request_id") == F.col("_poor"), "left")
        .withColumn("status_code", status)
        .select("request_id", "session_id", "status_code", code.alias("code"))
    )


def _without_funds(booked: DataFrame, refused: DataFrame, accounts: DataFrame) -> DataFrame:
    """The refused requests whose source could not pay after all earlier bookings."""
    needs = F.col("amount_minor")
    asks = refused.select(
        F.col("source_account_id").alias("account_id"), *ORDER, needs, F.lit(None).cast(EXACT).alias("signed_minor")
    )
    flows = _legs(booked, "amount_minor").select("account_id", *ORDER, "amount_minor", "signed_minor")
    # a booking has two accounts and a refusal is asked of one, so (account, time, id) tells rows apart
    rows = into_ranges(flows.unionByName(asks), ["account_id"], ORDER)
    known = prefix_sums(rows, ["account_id"], ORDER, {"_moved": F.col("signed_minor")})
    opening = accounts.select("account_id", F.col("opening_balance_minor").cast(EXACT).alias("_opening"))
    return (
        known.where(F.col("signed_minor").isNull())
        .join(opening, "account_id")
        .where(F.col("_opening") + F.col("_moved") < needs)
        .select("request_id")
    )
