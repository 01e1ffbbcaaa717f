"""Chat formatting by event-sourced reconstruction (DataFrame operations only).

A log holds events (conversation, seq, kind, message, role, text):

* ``message``: a message begins, or is sent whole, with this text;
* ``delta``: text streamed to the message, appended in the order of seq;
* ``edit``: the message's text so far is replaced;
* ``regenerate``: the message's text so far is dropped, to be streamed anew;
  later messages that had begun before it are dropped with it.

Fold: the events of one message meet first (so a hot conversation is spread
over its messages), its text is what follows the last event that resets it.
Then each conversation's messages are ordered by their first seq.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside roles
and texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|`` (in roles a newline
becomes ``\\n``), so no control string survives inside a text, and the
original is recovered exactly. ``loss_spans`` are the code point ranges of the
assistant texts in the formatted text, ``loss`` says the same by turn.

One conversation is one value in the end; its size bounds a task.

Defined cases: a null text or role counts as empty; a null seq sorts first;
null conversation ids form one conversation; events with equal seq are ordered
by text; an exact repetition of an event counts again (``message`` rows are
given a message each by ``turn_events``); an empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, MASKED = "<|im_start|>", "<|im_end|>\n", "assistant"
_PAIR = r"\\\\"  # a regular expression: two backslashes


def escape(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(x: Column) -> Column:
    return F.array_join(F.transform(F.split(x, _PAIR), lambda p: F.replace(p, F.lit("<\\|"), F.lit("<|"))), "\\")


def escape_role(x: Column) -> Column:
    return F.replace(escape(x), F.lit("\n"), F.lit("\\n"))


def unescape_role(x: Column) -> Column:
    return F.array_join(F.transform(F.split(x, _PAIR), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("<\\|"), F.lit("<|"))), "\\")


def turn_events(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """The events of a table of whole turns: one message per row, ordered by
    turn, then role and text (equal rows stay separate messages)."""
    w = Window.partitionBy(conv).orderBy(turn, role, text)
    seq = F.row_number().over(w).cast("long")
    return rows.select(F.col(conv).alias("conv"), seq.alias("seq"), F.lit("message").alias("kind"),
                       seq.alias("msg"), F.col(role).alias("role"), F.col(text).alias("text"))


def reconstruct(events: DataFrame) -> DataFrame:
    """(conv, at, msg, role, text): the final messages of each conversation."""
    seq = F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 63)))
    e = events.select("conv", seq.alias("seq"), "kind", "msg", F.coalesce("role", F.lit("")).alias("role"),
                      F.coalesce("text", F.lit("")).alias("text"))
    m = e.groupBy("conv", "msg").agg(
        F.min("seq").alias("at"),
        F.max(F.when(F.col("kind") != "delta", F.col("seq"))).alias("reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
        F.min(F.struct("seq", "role")).getField("role").alias("role"),
        F.collect_list(F.struct("seq", "text")).alias("parts"))
    live = F.filter(F.array_sort("parts"), lambda p: F.col("reset").isNull() | (p["seq"] >= F.col("reset")))
    m = m.withColumn("text", F.array_join(F.transform(live, lambda p: p["text"]), ""))
    before = Window.partitionBy("conv").orderBy("at", "msg").rowsBetween(Window.unboundedPreceding, -1)
    return (m.withColumn("cut", F.max("again").over(before))
            .where(F.col("cut").isNull() | (F.col("cut") <= F.col("at")))
            .select("conv", "at", "msg", "role", "text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv, formatted, loss_spans, loss): one row per conversation."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    m = messages.select("conv", "at", "msg", (F.col("role") == MASKED).alias("loss"), head.alias("head"),
                        escape(F.col("text")).alias("body"))
    size = F.char_length("head") + F.char_length("body") + len(END)
    before = Window.partitionBy("conv").orderBy("at", "msg").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0)) + F.char_length("head")
    m = m.withColumn("start", start).withColumn("end", F.col("start") + F.char_length("body"))
    turns = F.array_sort(F.collect_list(F.struct("at", "msg", "loss", "start", "end", "head", "body")))
    t = m.groupBy("conv").agg(turns.alias("turns"))
    return t.select(
        "conv", F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter("turns", lambda x: x["loss"]), lambda x: F.struct(x["start"], x["end"])).alias("loss_spans"),
        F.transform("turns", lambda x: x["loss"]).alias("loss"))


def format_log(events: DataFrame) -> DataFrame:
    """A log's conversations, reconstructed and rendered."""
    return render(reconstruct(events))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> parsed from a formatted conversation."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)
    body = lambda p: F.substring_index(p, END, 1)  # noqa: E731 - a text holds no control string
    return F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(body(p), "\n", 1)).alias("role"),
        unescape(F.substr(
            body(p), F.char_length(F.substring_index(body(p), "\n", 1)) + 2)).alias("text")))
