"""Chat formatting of event logs: fold events into messages, render them, read them back. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Byte order mark of UTF-32.
MARK = b"\x00\x00\xfe\xff"
START, STOP, NEW_LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
LOSS_ROLE = "assistant"

#: Events that begin a message anew; a `delta` adds to what is there.
RESETS = ["message", "edit", "regenerate"]


def escaped(text: Column) -> Column:
    r"""Text without control strings: every `<|`, `<\|`, `<\\|` .. gets one backslash more, all else stays."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def fold_events(events: DataFrame) -> DataFrame:
    """Events (conv_id, message_no, seq, event, role, text) to final messages: conv_id, message_no, role, text.

    By sequence within a message: `message` and `edit` set the text, `regenerate` empties it for the deltas that follow,
    `delta` adds to it; an event of another kind changes nothing. The role is the first one given. Null texts count as
    empty, roles that are never given too; events with equal sequence go by kind and text. A message exists as soon as
    one event names it.

    Everything before a message's last reset is dropped before its deltas are gathered; the events of one message are
    what a group holds.
    """
    message = Window.partitionBy("conv_id", "message_no")
    resets = F.col("event").isin(RESETS)
    place = F.struct("seq", "event", F.coalesce("text", F.lit("")).alias("text"))
    marked = events.select(
        "conv_id",
        "message_no",
        "role",
        place.alias("place"),
        F.max(F.when(resets, place)).over(message).alias("reset"),
    )
    counts = (F.col("place.event") == "delta") & (F.col("reset").isNull() | (F.col("place") > F.col("reset")))
    begin = F.when(F.col("reset.event").isin("message", "edit"), F.col("reset.text")).otherwise("")
    return (
        marked.groupBy("conv_id", "message_no")
        .agg(
            F.min(F.when(F.col("role").isNotNull(), F.struct("place", "role"))).alias("first"),
            F.max("reset").alias("reset"),
            F.sort_array(F.collect_list(F.when(counts, F.col("place")))).alias("parts"),
        )
        .select(
            "conv_id",
            "message_no",
            F.coalesce("first.role", F.lit("")).alias("role"),
            F.concat(begin, F.array_join(F.transform("parts", lambda p: p["text"]), "")).alias("text"),
        )
    )


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Messages to one row per conversation: conv_id, formatted, loss_spans (start and end, code points).

    The spans cover the escaped texts of `loss_role` and nothing else. A conversation is one string by its nature; its
    messages are what a group holds.
    """
    role = F.regexp_replace(escaped(F.col("role")), "\n", NEW_LINE)
    turns = (
        messages.select("conv_id", "message_no", (F.col("role") == loss_role).alias("loss"), role.alias("role"), escaped(F.col("text")).alias("text"))
        .withColumn("head", F.concat(F.lit(START), "role", F.lit("\n")))
        .withColumn("turn", F.concat("head", "text", F.lit(STOP + "\n")))
    )
    so_far = Window.partitionBy("conv_id").orderBy("message_no")
    placed = (
        turns.withColumn("end", F.sum(F.length("turn")).over(so_far) - len(STOP + "\n"))
        .withColumn("start", F.col("end") - F.length("text"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("message_no", "turn", "loss", "start", "end"))).alias("turns"))
    )
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return placed.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), spans.alias("loss_spans")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a rendered conversation, as an array of (role, text)."""
    bodies = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda body: body != "")

    def turn(body: Column) -> Column:
        head = F.substring_index(body, "\n", 1)
        role = unescaped(F.regexp_replace(F.substring(head, len(START) + 1, 2**31 - 1), r"<\|nl\|>", "\n"))
        return F.struct(role.alias("role"), unescaped(F.substr(body, F.length(head) + 2)).alias("text"))

    return F.transform(bodies, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped. Four bytes a code point make each span's place a plain offset.

    The decoder drops one leading byte order mark, so each cut gets one of its own and keeps a U+FEFF of the text.
    """
    wide = F.encode(formatted, "UTF-32")
    cut = lambda s: F.substr(wide, (s["start"] * 4 + 1).cast("int"), ((s["end"] - s["start"]) * 4).cast("int"))
    return F.array_join(F.transform(spans, lambda s: unescaped(F.decode(F.concat(F.lit(MARK), cut(s)), "UTF-32"))), "")
