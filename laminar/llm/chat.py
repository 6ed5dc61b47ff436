"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: whole messages, streamed deltas, edits and regenerations, each with a
sequence number and the index of the message it concerns.  The fold leaves

* ``message``: a message of its own, whole;
* ``delta``: a piece appended to the message of its index;
* ``edit``: replaces what the message of its index held before;
* ``regenerate``: discards its message and all with a larger index from before, then starts that message anew
  with its own text (mostly none; later deltas fill it).

The messages are rendered with marks for turns, control strings inside roles and texts are escaped
reversibly, and the spans of the loss mask (all texts of the trained role) are positions in the output.

Scale.  Events are partitioned by conversation, split into blocks of sequence numbers, so one huge conversation is
folded in many tasks: the regeneration that cuts an event off is found per block first, then over the
blocks.  Messages are joined per (conversation, message), and only rendered messages meet, in the row that
holds the conversation's text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template: what opens and closes a turn, its role and its text.
OPEN, ROLE, TEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
# A control string with any number of escape marks after its first sign; text keeps at least one mark.
_LOOSE = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
_SEQ_BLOCK = 4096
LOWEST = -(1 << 62)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _LOOSE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, msg, seq, role, text, copy)`` of ``events(conv_id, seq, kind, msg, role, text)``.

    Null texts and roles count as empty, a null kind as ``message``, null sequence numbers and message indexes as
    smaller than all others; a null conversation id names a conversation of its own.  Equal sequence numbers are ordered by kind
    (edits and regenerations after what they follow), role and text.  Repeated whole messages stay
    repeated.  A delta without a message before it starts one.
    """
    e = events.select(
        "conv_id",
        F.coalesce(F.col("seq").cast("long"), F.lit(LOWEST)).alias("seq"), F.coalesce("kind", F.lit("message")).alias("kind"), F.coalesce(F.col("msg").cast("long"), F.lit(LOWEST)).alias("msg"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    starts = F.col("kind") != "delta"
    # within a sequence block: the smallest message index that a later event regenerates
    block = F.floor(F.col("seq") / _SEQ_BLOCK)
    cut = F.when(F.col("kind") == "regenerate", F.col("msg"))
    later = Window.partitionBy("conv_id", "block").orderBy(F.col("seq").desc()).rangeBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("block", block).withColumn("cut_here", F.min(cut).over(later))
    # and over the later blocks: one row per conversation and block that regenerates anything
    cuts = (e.where(F.col("kind") == "regenerate").groupBy("conv_id", "block").agg(F.min("msg").alias("low"))
            .groupBy(F.col("conv_id").alias("cut_id")).agg(F.collect_list(F.struct("block", "low")).alias("cuts")))
    far = F.array_min(F.transform(F.filter("cuts", lambda c: c["block"] > F.col("block")), lambda c: c["low"]))
    alive = (e.join(cuts, F.col("conv_id").eqNullSafe(F.col("cut_id")), "left").withColumn("cut", F.least("cut_here", far))
             .where(F.col("cut").isNull() | (F.col("msg") < F.col("cut"))).drop("cuts", "cut", "cut_here", "cut_id", "block"))
    # what an edit or a regeneration of the same message replaces goes too
    same = Window.partitionBy("conv_id", "msg")
    reset = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).over(same)
    alive = alive.withColumn("reset", reset).where(
        F.col("reset").isNull() | (F.col("seq") > F.col("reset"))
        | ((F.col("seq") == F.col("reset")) & F.col("kind").isin("edit", "regenerate")))
    along = Window.partitionBy("conv_id", "msg").orderBy("seq", F.when(starts, 0).otherwise(1), "role", "text")
    numbered = alive.withColumn("copy", F.sum(F.when(starts, 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    piece = F.struct("seq", (~starts).cast("int").alias("after"), "text")
    return (numbered.groupBy("conv_id", "msg", "copy")
            .agg(F.min("seq").alias("seq"), F.min_by("role", F.struct("seq", (~starts).cast("int"), "role")).alias("role"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"]), "").alias("text")))


def render(messages: DataFrame, train_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``(conv_id, formatted, n_turns, loss_spans)``.

    ``loss_spans`` are (start, length) in code points of ``formatted``, one per text of ``train_role``, in order.
    """
    opened = F.concat(F.lit(OPEN + ROLE), escape(F.col("role")), F.lit(TEXT))
    turns = messages.select("conv_id", "msg", "copy", "seq", F.col("role") == train_role, opened.alias("head"),
                            escape(F.col("text")).alias("body")).toDF("conv_id", "msg", "copy", "seq", "train", "head", "body")
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("msg", "seq", "copy", "head", "body", "train"))).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    lengths = F.transform("turns", lambda t: F.struct(
        F.length(t["head"]).alias("head"), F.length(t["body"]).alias("body"), t["train"].alias("train")))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc, t):
        begin = acc["at"] + t["head"]
        span = F.struct(begin.cast("long").alias("start"), t["body"].cast("long").alias("length"))
        return F.struct((begin + t["body"] + len(CLOSE)).cast("long").alias("at"),
                        F.when(t["train"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return (whole.withColumn("formatted", text).withColumn("lengths", lengths)
            .select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"),
                    F.aggregate("lengths", start, step, lambda acc: acc["spans"]).alias("loss_spans")))


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation: an array of ``(role, text)``, unescaped."""
    # every turn begins with OPEN + ROLE and ends with CLOSE; escaped text holds none of them
    turns = F.filter(F.split(formatted, r"\Q" + OPEN + ROLE + r"\E"), lambda t: t != "")
    def parse(turn):
        mark = F.locate(TEXT, turn)
        return F.struct(unescape(F.substring(turn, F.lit(1), mark - 1)).alias("role"),
                        unescape(F.substring(turn, mark + len(TEXT), F.length(turn) - mark - len(TEXT) - len(CLOSE) + 1)).alias("text"))
    return F.transform(turns, parse)


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def format_chats(events: DataFrame, train_role: str = "assistant") -> DataFrame:
    """Event log to rendered conversations; an empty log gives no rows, other columns are ignored."""
    return render(fold_events(events), train_role)
