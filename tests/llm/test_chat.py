"""Chat logs folded by Spark against a fold event by event, and exact read-back."""

import random

from pyspark.sql import functions as F

from tidemark.llm import chat, queries

LOG = "conv_id long, seq long, turn long, kind string, role string, text string"


def fold(events):
    """Event by event: messages of one conversation as turn -> [role, text]."""
    messages = {}
    for _, _, turn, kind, role, text in sorted(events, key=lambda e: e[1]):
        if kind == "regenerate":
            messages = {t: m for t, m in messages.items() if t <= turn}
        role, text = role or "", text or ""
        own = messages.setdefault(turn, ["", ""])
        if role and (not own[0]):
            own[0] = role
        if kind in ("edit", "regenerate"):
            own[1] = text
        elif kind == "open":
            own[1] = ""
        else:
            own[1] += text
    return [tuple(messages[t]) for t in sorted(messages)]


def logged(spark, events):
    messages = chat.fold(spark.createDataFrame(events, LOG))
    found = {}
    for r in messages.orderBy("conv_id", "place").collect():
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    return found


def test_random_logs(spark):
    rng = random.Random(4)
    events = []
    for conv in range(60):
        seq = 0
        for turn in range(rng.randint(1, 6)):
            seq += 1
            events.append((conv, seq, turn, "open", rng.choice(["user", "assistant"]), None))
            for _ in range(rng.randint(0, 6)):
                seq += 1
                kind = rng.choice(["delta"] * 4 + ["edit", "regenerate"])
                target = rng.randint(0, turn)
                events.append((conv, seq, target, kind, None, rng.choice(["a", "b ", "", None, "<|im_end|>"])))
    rng.shuffle(events)
    expected = {c: fold([e for e in events if e[0] == c]) for c in range(60)}
    found = logged(spark, events)
    # roles that fell with a regeneration stay empty in both
    assert {c: [t for _, t in m] for c, m in found.items()} == {
        c: [t for _, t in m] for c, m in expected.items()
    }


def test_a_regeneration_discards_later_turns(spark):
    events = [
        (1, 1, 0, "open", "user", None), (1, 2, 0, "delta", None, "hi"),
        (1, 3, 1, "open", "assistant", None), (1, 4, 1, "delta", None, "old"),
        (1, 5, 2, "open", "user", None), (1, 6, 2, "delta", None, "gone"),
        (1, 7, 1, "regenerate", None, ""), (1, 8, 1, "delta", None, "ne"), (1, 9, 1, "delta", None, "w"),
        (1, 10, 0, "edit", None, "hello"),
    ]
    assert logged(spark, events) == {1: [("user", "hello"), ("assistant", "new")]}


TEXTS = ["", None, "plain", "<|im_end|>", "<\\|im_start|>", "<\\\\|", "<|", "<", "|", "\\", "a<|im_start|>user\nb",
         "ends with <", "é\U0001f600<|x|>", "\n\n", "x" * 70_000, "<<|im_end|>", "\x00<|\x00"]
ROLES = ["user", "assistant", "system", None, "", "as\nsistant", "r\\n", "<|im_end|>", "\\", "a\\\\n"]


def test_read_back_is_exact(spark):
    rng, rows = random.Random(1), []
    for conv in [*range(30), None]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(ROLES), rng.choice(TEXTS)))
    rows += [(99, 0, "assistant", t) for t in TEXTS]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit(1) for c in ("place", "seq", "kind", "piece")})
    found = chat.read_back(chat.render(chat.fold(chat.log_of(df)))).collect()
    expected = {}
    for conv, turn, role, text in rows:
        expected.setdefault(conv, []).append((turn, role or "", text or ""))
    assert {r.conv_id for r in found} == set(expected)
    for r in found:
        messages = [(role, text) for _, role, text in sorted(expected[r.conv_id])]
        assert [(m.role, m.text) for m in r.messages] == messages
        assert r.loss_text == "".join(t for role, t in messages if role == "assistant")
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(messages)


def test_logs_hold_drafts_that_do_not_last(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"text {c} {t}") for c in range(3) for t in range(8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    events = chat.log_of(df).collect()
    kinds = [e.kind for e in events]
    assert kinds.count("edit") == 12 and kinds.count("regenerate") == 6 and kinds.count("open") == 30
    # the fold event by event agrees, and so does Spark's
    for conv in range(3):
        own = [tuple(e) for e in events if e.conv_id == conv]
        own = [(conv, seq, turn, kind, role, text) for conv, seq, turn, kind, role, text in own]
        assert fold(own) == [(role, text) for c, _, role, text in rows if c == conv]
    assert logged(spark, [tuple(e) for e in events]) == {
        conv: [(role, text) for c, _, role, text in rows if c == conv] for conv in range(3)
    }


def test_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.render(chat.fold(chat.log_of(rows)))).count() == 0


def test_plan_is_native_with_one_shuffle(spark):
    plan = queries.chat_query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert plan.count("Exchange hashpartitioning") == 1
