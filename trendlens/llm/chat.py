"""Operator 2, chat formatting by event-sourced reconstruction (DataFrame
functions only).

A log has one row per event: (conv_id, seq, kind, message, role, text).
``message`` numbers the messages of a conversation. Kinds:

* ``delta``: appends its text to the message (the first one opens it);
* ``edit``: replaces what the message holds so far;
* ``regenerate``: empties the message, takes the text as its new beginning, and
  drops every later message as it stands.

``fold`` partitions the log by conversation, sorts by sequence, and folds it to
the final messages; ``render`` writes them with a reversible template and the
spans of the assistant texts; ``read_back`` parses rendered text again.

Defined results: NULL texts and roles are empty; ties in ``seq`` go by message,
kind and text, so repeated events are applied again, in a fixed order; a message
whose every event is dropped disappears; an empty log has no conversations. A
NULL conv_id is a conversation of its own. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The template. Every control string begins with "<|"; ``escape`` leaves no "<|"
# and no bare backslash in a text.
START, END, NEWLINE = "<|start|>", "<|end|>", "\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("<\\n>"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("<\\n>"), F.lit("\n")))


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final messages. An event survives
    unless a later edit or regenerate of its own message, or a later regenerate
    of an earlier message, undoes it. All windows and the grouping share one
    shuffle by conversation."""
    order = [F.col("seq"), F.col("message"), F.col("kind"), F.col("text")]
    ev = log.select(
        "conv_id", "seq", F.coalesce("kind", F.lit("delta")).alias("kind"), "message",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conv = Window.partitionBy("conv_id").orderBy(*order)
    at = ev.withColumn("at", F.row_number().over(conv))
    # Newest first, so that "all later events" is a running frame (linear time).
    later = (Window.unboundedPreceding, -1)
    after = Window.partitionBy("conv_id").orderBy(F.desc("at")).rowsBetween(*later)
    own = Window.partitionBy("conv_id", "message").orderBy(F.desc("at")).rowsBetween(*later)
    undone = at.withColumn(
        "cut", F.min(F.when(F.col("kind") == "regenerate", F.col("message"))).over(after)).withColumn(
        "reset", F.max(F.col("kind") != "delta").over(own))
    alive = undone.filter(~F.coalesce("reset", F.lit(False)) &
                          (F.col("cut").isNull() | (F.col("cut") >= F.col("message"))))
    parts = F.sort_array(F.collect_list(F.struct("at", "role", "text")))
    return alive.groupBy("conv_id", "message").agg(parts.alias("parts")).select(
        "conv_id", "message", F.col("parts")[0]["role"].alias("role"),
        F.array_join("parts.text", "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): one row per conversation. ``loss`` lists the
    spans (start, length, in code points of ``formatted``) of assistant texts."""
    piece = F.struct(
        "message",
        F.concat(F.lit(START), _escape_role(F.col("role")), F.lit(NEWLINE)).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == "assistant").alias("loss"))
    whole = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("m"))
    tail = END + NEWLINE
    spans = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(s, m):
        start = s["at"] + F.length(m["head"])
        span = F.struct(start.alias("start"), F.length(m["body"]).alias("length"))
        return F.struct(
            (start + F.length(m["body"]) + F.lit(len(tail))).alias("at"),
            F.when(m["loss"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    return whole.select(
        "conv_id",
        F.array_join(F.transform("m", lambda m: F.concat(m["head"], m["body"], F.lit(tail))), "").alias("formatted"),
        F.aggregate("m", spans, step, lambda s: s["spans"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted) of rendered rows: the turns as
    (role, text) and the unescaped texts under the loss mask, in order."""
    def turn(block):
        head = F.substring_index(block, NEWLINE, 1)
        body = F.substr(block, F.length(head) + 2, F.length(block) - F.length(head) - 1 - len(END + NEWLINE))
        return F.struct(_unescape_role(head).alias("role"), unescape(body).alias("text"))

    blocks = F.slice(F.split("formatted", START.replace("|", r"\|"), -1), 2, F.length("formatted"))
    loss = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select("conv_id", F.transform(blocks, turn).alias("turns"),
                            F.array_join(loss, "").alias("loss_text"), "formatted")


def log_of_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """Stored conversations as a log: each row is one whole message, numbered by
    turn (then role and text, for rows of one turn)."""
    by = Window.partitionBy(conv).orderBy(turn, role, text)
    n = F.row_number().over(by)
    return rows.select(F.col(conv).alias("conv_id"), n.alias("seq"), F.lit("delta").alias("kind"),
                       n.alias("message"), F.col(role).alias("role"), F.col(text).alias("text"))


def digest(parsed: DataFrame) -> DataFrame:
    """The counts and digests of conversations as they were read back."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
