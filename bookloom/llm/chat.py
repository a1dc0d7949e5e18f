"""Chat formatting from an event log, with DataFrame functions alone.

A conversation's log holds events in the order of ``seq``: ``message`` sets a turn's text, ``delta``
appends to it, ``edit`` replaces it, ``regenerate`` empties it for the deltas that follow, ``delete``
removes the turn. Folding gives the final messages, which are rendered in a turn-marked template whose
control strings cannot occur inside a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    r"""Every ``<|`` (with any backslashes between) gets one more backslash, so no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: backslash and line feed are escaped besides control strings."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def by_conversation(log: DataFrame) -> DataFrame:
    """The log dealt by conversation: all steps after it group by the conversation and find their rows together.

    This is the one shuffle of a log; without it the steps by turn and those by conversation shuffle each.
    """
    return log.repartition("conv_id")


def fold_events(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of a log (conv_id, turn, seq, kind, role, text).

    ``kind`` null counts as ``message``; a null text is empty. Within a turn events are taken by seq, then
    kind, role and text, so ties and repeated rows have one order. A turn's role is the last one given.
    Turns whose last resetting event is ``delete`` disappear. An empty log gives no rows; other columns
    are ignored. Events of one turn meet in one group; a conversation's turns do not.
    """
    event = F.struct("seq", F.coalesce("kind", F.lit("message")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = log.select("conv_id", "turn", event.alias("e")).groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list("e")).alias("events"))
    last = F.array_max(F.transform("events", lambda x, i: F.when(x["kind"] != "delta", i)))
    kept = F.when(last.isNull(), F.col("events")).otherwise(F.slice("events", last + 1, F.size("events") - last))
    text = F.array_join(F.transform(kept, lambda x: F.when(x["kind"] == "regenerate", F.lit("")).otherwise(x["text"])), "")
    role = F.element_at(F.filter(F.transform("events", lambda x: x["role"]), lambda x: x.isNotNull()), -1)
    gone = F.coalesce(F.get("events", last)["kind"] == "delete", F.lit(False))
    return turns.where(~gone).select("conv_id", "turn", F.when(F.exists("events", lambda x: x["role"].isNotNull()), role).alias("role"), text.alias("text"))


def rows_as_events(rows: DataFrame) -> DataFrame:
    """A table of finished turns as a log: each row is one message; rows of the same turn stay apart.

    Rows of a conversation that share a turn (ties, repeats) become turns of their own, ordered by role
    and text.
    """
    same = Window.partitionBy("conv_id", "turn").orderBy(F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = rows.select("conv_id", "turn", "role", "text").withColumn("at", F.row_number().over(same))
    return numbered.select("conv_id", F.struct("turn", "at").alias("turn"), F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", "text")


def render(messages: DataFrame, loss_role: str = "assistant", chunk: int = 256) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (array of start, n_chars, loss_start, loss_chars).

    Offsets are code points of ``formatted``; the loss mask covers the texts of ``loss_role`` and nothing
    else. Null roles and texts are empty. Turns are first joined in runs of ``chunk``, so that a very long
    conversation is not sorted as one array of turns; its formatted text is one value all the same.
    """
    role, text = escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    is_loss = F.coalesce(F.col("role"), F.lit("")) == loss_role
    turns = (
        messages.select("conv_id", "turn", "role", "text", F.concat(head, text, F.lit(f"{END}\n")).alias("segment"), F.char_length(head).alias("head"), F.char_length(text).alias("body"), is_loss.alias("is_loss"))
        .withColumn("n_chars", F.char_length("segment").cast("long"))
        .withColumn("start", F.coalesce(F.sum("n_chars").over(before), F.lit(0)))
        .withColumn("at", F.row_number().over(order))
        .select("conv_id", "at", "segment", F.struct("start", "n_chars", (F.col("start") + F.col("head")).alias("loss_start"), F.when(F.col("is_loss"), F.col("body")).otherwise(0).cast("long").alias("loss_chars"), F.col("is_loss").alias("is_loss")).alias("span"))
    )
    runs = turns.groupBy("conv_id", F.expr(f"(at - 1) div {chunk}").alias("run")).agg(F.array_sort(F.collect_list(F.struct("at", "segment", "span"))).alias("x"))
    runs = runs.select("conv_id", "run", F.array_join(F.col("x.segment"), "").alias("text"), F.col("x.span").alias("spans"))
    whole = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("run", "text", "spans"))).alias("x"))
    return whole.select("conv_id", F.array_join(F.col("x.text"), "").alias("formatted"), F.flatten(F.col("x.spans")).alias("turns"))


def format_log(log: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Folds a log (of ``by_conversation``) and renders it; see ``fold_events`` and ``render``."""
    return render(fold_events(log), loss_role)


def read_back(formatted: DataFrame) -> DataFrame:
    """Messages and loss texts read back from ``formatted`` and its offsets alone.

    conv_id, formatted, messages (array of role, text), losses (array of text under the mask, unescaped).
    """
    segments = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, F.size("turns") + 1)
    body = lambda s: F.substring_index(s, f"{END}\n", 1)
    message = lambda s: F.struct(unescape_role(F.substring_index(body(s), "\n", 1)).alias("role"), unescape(F.expr("''") if s is None else body(s).substr(F.locate("\n", s) + 1, F.length(s))).alias("text"))
    skipped = len(START)
    masked = F.filter(F.arrays_zip(F.col("segments"), F.col("turns")), lambda x: x["turns"]["is_loss"])
    loss = lambda x: unescape(x["segments"].substr((x["turns"]["loss_start"] - x["turns"]["start"] - skipped + 1).cast("int"), x["turns"]["loss_chars"].cast("int")))
    return formatted.withColumn("segments", segments).select("conv_id", "formatted", F.transform("segments", message).alias("messages"), F.transform(masked, loss).alias("losses"))
