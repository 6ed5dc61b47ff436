"""Event folding and rendering against a plain replay of the log."""

import random

from pyspark.sql import functions as F

from laminar.llm.chat import escape, fold_events, format_chats, masked_texts, read_back, unescape

LOG = "conv_id long, seq long, kind string, msg long, role string, text string"


def replay(events):
    """The fold, event by event."""
    convs = {}
    for conv, _, kind, msg, role, text in events:
        state = convs.setdefault(conv, [])  # [msg, role, text]
        role, text = role or "", text or ""
        if kind == "edit":
            state[:] = [m for m in state if m[0] != msg] + [[msg, role, text]]
        elif kind == "regenerate":
            state[:] = [m for m in state if m[0] < msg] + [[msg, role, text]]
        elif kind == "delta" and any(m[0] == msg for m in state):
            [m for m in state if m[0] == msg][-1][2] += text
        else:
            state.append([msg, role, text])
    return {c: [(r, t) for _, r, t in sorted(s, key=lambda m: m[0])] for c, s in convs.items()}


def formatted(spark, events):
    done = format_chats(spark.createDataFrame(events, LOG).withColumn("copy", F.lit("clash")))
    rows = done.select("conv_id", "n_turns", read_back(F.col("formatted")).alias("turns"),
                       masked_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in rows:
        assert r.n_turns == len(r.turns) and r.loss == [t.text for t in r.turns if t.role == "assistant"]
    return {r.conv_id: [tuple(t) for t in r.turns] for r in rows}


def test_random_logs_equal_the_replay(spark):
    rng, events = random.Random(4), []
    for conv in range(40):
        for seq in range(rng.randrange(1, 40)):
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            msg = seq if kind == "message" else rng.randrange(0, seq + 1)
            events.append((conv, seq * 700, kind, msg, ["user", "assistant"][msg % 2], rng.choice(["a", "b</s>", "", "[INST]c", None])))
    # a role belongs to a message, so parity of the index gives it; sequence numbers span several blocks
    assert formatted(spark, events) == replay(events)


def test_nulls_ties_and_repeats(spark):
    events = [(1, 0, None, 0, None, None), (1, 1, "message", 1, "assistant", "x"), (1, 1, "message", 1, "assistant", "x"),
              (None, 0, "message", 0, "user", "no conversation id")]
    assert formatted(spark, events) == {1: [("", ""), ("assistant", "x"), ("assistant", "x")],
                                        None: [("user", "no conversation id")]}
    events = [(None, None, "message", None, "user", "old"), (None, 5, "regenerate", None, "user", "new"), (None, 6, "delta", None, "user", "er")]
    assert formatted(spark, events) == {None: [("user", "newer")]}
    assert fold_events(spark.createDataFrame([], LOG)).count() == 0
    assert format_chats(spark.createDataFrame([], LOG)).count() == 0


def test_control_strings_survive(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["<", "s>", "/s>", "</s>", "<s>", "[", "INST]", "[INST]", "[/INST]", "\\", "$1", "\n", "é"])
                     for _ in range(rng.randrange(0, 9))) for _ in range(400)] + ["</s>[INST] ok [/INST]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.withColumn("u", unescape(F.col("e"))).collect():
        assert r.u == r.t and not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))
    events = [(i, 0, "message", 0, "user", t) for i, t in enumerate(texts)] + \
             [(i, 1, "message", 1, t, t) for i, t in enumerate(texts)]
    assert formatted(spark, events) == {i: [("user", t), (t, t)] for i, t in enumerate(texts)}
