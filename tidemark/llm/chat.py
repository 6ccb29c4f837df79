"""Chat formatting from an event log, in DataFrame functions alone.

A log holds one row per event: conv_id, seq, turn, kind, role, text. Kinds:

* ``open`` starts a message with its role; ``delta`` appends to its turn's text;
* ``edit`` replaces the text of its turn so far;
* ``regenerate`` discards what its turn and all later turns hold so far, and starts its turn anew.

Events of a conversation are taken in order of seq (ties by turn, kind, text). Rows with equal seq,
turn and kind all count. ``fold`` yields the messages that are left, ``render`` one formatted text per
conversation with the spans that bear loss, ``read_back`` the messages and loss text from that output.

Format: ``<|im_start|>role\\ntext<|im_end|>\\n`` per message. In texts and roles a backslash is put into
``<|`` and one more into each ``<\\|``, ``<\\\\|``, ..., so ``<|`` occurs in marks only; in roles a backslash
is written ``\\\\`` and a line feed ``\\n``. Both are undone exactly. Spans count code points and cover
assistant texts without their marks.

NULL texts and roles are empty, a NULL conv_id is a conversation of its own, an empty text is kept as
an empty message, a log without rows gives no conversations. Further columns are not read. Everything
after the one shuffle by conversation keeps its partitioning; windows spill to disk, and what one task
must hold at once is a single conversation's formatted text, which is one output value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # a doubled backslash first becomes a mark that an escaped role cannot hold: a bare line feed
    plain = F.replace(unescape(role), F.lit("\\\\"), F.lit("\n"))
    marked = F.replace(plain, F.lit("\\n"), F.lit("\0n"))
    return F.replace(F.replace(marked, F.lit("\n"), F.lit("\\")), F.lit("\0n"), F.lit("\n"))


def fold(log: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, role, text, place (from 0 within the conversation).

    Turns that hold nothing but events discarded by a regeneration disappear.
    """
    conversation = Window.partitionBy("conv_id")
    earlier_turns = conversation.orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    of_turn = Window.partitionBy("conv_id", "turn")
    regenerated = F.when(F.col("kind") == "regenerate", F.col("seq"))
    restarted = F.when(F.col("kind").isin("open", "edit", "regenerate"), F.col("seq"))
    log = log.select(
        "conv_id",
        "seq",
        "turn",
        "kind",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    kept = (
        log.withColumn("cut", F.max(regenerated).over(earlier_turns))
        .where(F.col("cut").isNull() | F.col("turn").isNull() | (F.col("seq") > F.col("cut")))
        .withColumn("since", F.max(restarted).over(of_turn))
    )
    says = (F.col("kind") != "open") & (F.col("since").isNull() | (F.col("seq") >= F.col("since")))
    event = F.struct("seq", "kind", "text")
    folded = kept.groupBy("conv_id", "turn").agg(
        F.min_by("role", F.when(F.col("role") != "", F.struct("seq", "role"))).alias("role"),
        F.sort_array(F.collect_list(F.when(says, event))).alias("events"),
    )
    order = conversation.orderBy("turn")
    return folded.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.col("events.text"), "").alias("text"),
        (F.row_number().over(order) - 1).alias("place"),
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (array of start and end code points)."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = messages.select(
        "conv_id",
        "place",
        "role",
        F.char_length(head).cast("long").alias("head_chars"),
        F.char_length(body).cast("long").alias("body_chars"),
        F.concat(head, body, F.lit(END + "\n")).alias("piece"),
    )
    before = (
        Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = pieces.withColumn(
        "begin",
        F.coalesce(F.sum(F.char_length("piece").cast("long")).over(before), F.lit(0))
        + F.col("head_chars"),
    )
    span = F.struct(F.col("begin"), (F.col("begin") + F.col("body_chars")).alias("end"))
    return placed.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("place", "piece"))), lambda p: p["piece"]),
            "",
        ).alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("role") == LOSS_ROLE, span))).alias("loss"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Messages (array of role and text) and loss_text, parsed from the output alone."""
    opened = F.split(F.col("formatted"), r"<\|im_start\|>")
    message = lambda part: F.struct(
        unescape_role(F.substring_index(part, "\n", 1)).alias("role"),
        unescape(
            F.substring_index(
                part.substr(F.locate("\n", part) + 1, F.char_length(part)), END, 1
            )
        ).alias("text"),
    )
    under_loss = F.transform(
        "loss",
        lambda s: unescape(
            F.col("formatted").substr((s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))
        ),
    )
    return rendered.select(
        "conv_id",
        "formatted",
        "loss",
        F.transform(F.slice(opened, 2, F.size(opened)), message).alias("messages"),
        F.array_join(under_loss, "").alias("loss_text"),
    )


#: After the events of all turns of a conversation.
LATE = 1 << 40


def log_of(rows: DataFrame) -> DataFrame:
    """A table of messages as the log of a conversation that came to them by drafts, edits and regenerations.

    By turn number, a message is streamed in two deltas; or a draft is edited to its first half and goes on; or
    a draft and what followed it are discarded by a regeneration; or a draft stands until an edit after
    all turns. Rows of one turn number are messages of their own, in order of role and text. NULL turns
    come first.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    own = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), role, text)
    half = F.floor(F.char_length("text") / 2).cast("int")
    empty, whole = F.lit(""), F.col("text")
    head, tail = whole.substr(F.lit(1), half), whole.substr(half + 1, F.char_length("text"))
    draft = F.concat(F.reverse("text"), F.lit(" draft"))
    turn = F.col("turn")

    def event(step: int, kind: str, text: Column, role: Column = empty, ahead: int = 0) -> Column:
        seq = turn * 10 + step if step < LATE else turn + step
        fields = {"seq": seq, "turn": turn + ahead, "kind": F.lit(kind), "role": role, "text": text}
        return F.struct(*(value.alias(name) for name, value in fields.items()))

    opened = event(0, "open", empty, F.col("role"))
    streamed = [event(7, "delta", head), event(8, "delta", tail)]
    edited = [event(1, "delta", draft), event(2, "edit", head), event(3, "delta", tail)]
    followed = [event(2, "open", empty, F.lit("discarded"), 1), event(3, "delta", draft, ahead=1)]
    regenerated = [event(1, "delta", draft), *followed, event(4, "regenerate", empty), *streamed]
    late = [event(1, "delta", draft), event(LATE, "edit", whole)]
    kinds = [F.array(opened, *events) for events in (streamed, edited, regenerated, late)]
    log = F.when(turn % 4 == 1, kinds[1]).when(turn % 4 == 2, kinds[2]).when(turn % 4 == 3, kinds[3])
    return rows.select(
        "conv_id", F.row_number().over(own).cast("long").alias("turn"), role.alias("role"), text.alias("text")
    ).select("conv_id", F.inline(log.otherwise(kinds[0])))
