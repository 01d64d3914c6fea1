"""Chat formatting from an event log, in DataFrame operations only.

A conversation is a log of events ordered by ``seq``.  Each event names a
message (``msg``) and one of these kinds:

- ``message``: starts the message over with ``role`` and ``text``;
- ``delta``: appends ``text`` to it (streamed output);
- ``edit``: replaces its text and drops the later messages logged so far;
- ``regenerate``: empties it (deltas follow) and drops the later messages
  logged so far.

``fold_events`` partitions the log by conversation, sorts it by sequence and
folds it into final messages; ``render`` turns these into one formatted string
per conversation with its loss mask; ``read_back`` parses that string again.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Inside texts and
roles a backslash becomes two, and every control string gets a backslash after
its first character, so no control string is left in them and both steps can
be undone in reverse order.

The loss mask is one span per turn, ``start`` and ``end`` in code points of the
formatted string, empty unless the role is ``assistant``.

Defined results: null texts and roles are empty; a null conversation id is a
conversation of its own; events that tie on ``seq`` are taken in order of
(msg, kind, role, text); a conversation whose messages were all dropped has no
row; an empty log gives no rows.  One conversation becomes one string, so its
length is bounded by what a single value can hold (2 GB).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
#: Strings that mean something to this template or to other common ones.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BACKSLASH = "\\"
LINE = "<|line|>"  # a line break inside a role
TRAINED_ROLE = "assistant"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _guarded(control: str) -> str:
    return control[0] + BACKSLASH + control[1:]


def escape(text: Column) -> Column:
    doubled = _replace(text, BACKSLASH, BACKSLASH * 2)
    return reduce(lambda t, c: _replace(t, c, _guarded(c)), CONTROL, doubled)


def unescape(text: Column) -> Column:
    bare = reduce(lambda t, c: _replace(t, _guarded(c), c), CONTROL, text)
    return _replace(bare, BACKSLASH * 2, BACKSLASH)


def escape_role(role: Column) -> Column:
    return _replace(escape(role), "\n", _guarded(LINE))


def unescape_role(role: Column) -> Column:
    return unescape(_replace(role, _guarded(LINE), "\n"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id, msg, role, text`` from ``conv_id, seq, kind, msg, role, text``."""
    order = ["seq", "msg", "kind", "role", "text"]
    log = Window.partitionBy("conv_id").orderBy(*order)
    later = log.rowsBetween(1, Window.unboundedFollowing)
    kind, cuts = F.col("kind"), F.col("kind").isin("edit", "regenerate")
    placed = events.select(
        "conv_id", "msg", "kind", "role",
        F.when(kind == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit(""))).alias("text"),
        F.row_number().over(log).alias("at"),
        F.min(F.when(cuts, F.col("msg"))).over(later).alias("cut"),
    )
    live = placed.where(F.col("cut").isNull() | (F.col("cut") >= F.col("msg")))
    of_message = Window.partitionBy("conv_id", "msg")
    starts = F.max(F.when(F.col("kind") != "delta", F.col("at"))).over(of_message)
    kept = live.withColumn("from", F.coalesce(starts, F.lit(0)))
    return kept.groupBy("conv_id", "msg").agg(
        F.coalesce(F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at"))), F.lit("")).alias("role"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("at") >= F.col("from"), F.struct("at", "text")))),
                lambda piece: piece["text"],
            ),
            "",
        ).alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans``: one row per conversation, turns ordered by ``msg``."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    drawn = messages.select(
        "conv_id", "msg",
        F.concat(head, body, F.lit(END + "\n")).alias("turn"),
        F.length(head).alias("head"), F.length(body).alias("body"),
        (F.col("role") == TRAINED_ROLE).alias("trained"),
    )
    upto = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(upto), F.lit(0)) + F.col("head")
    spans = drawn.select(
        "conv_id", "msg", "turn",
        F.struct(start.alias("start"), (start + F.when(F.col("trained"), F.col("body")).otherwise(0)).alias("end")).alias("span"),
    )
    turns = spans.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("msg", "turn", "span"))).alias("t"))
    return turns.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"),
        F.transform("t", lambda x: x["span"]).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Turns parsed from the formatted string: ``conv_id, pos, role, text, loss_text``.

    ``loss_text`` is what the turn's loss span covers, unescaped.
    """
    parts = F.split("formatted", r"<\|im_end\|>\n")
    each = rendered.select(
        "conv_id",
        F.posexplode(F.arrays_zip(F.slice(parts, 1, F.size(parts) - 1).alias("part"), F.col("loss_spans").alias("span"))).alias("pos", "p"),
    ).select("conv_id", "pos", "p.part", "p.span")
    upto = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.length("part") + F.lit(len(END) + 1)).over(upto), F.lit(0))
    at = F.col("span.start") - offset + 1
    marked = F.substring("part", at.cast("int"), (F.col("span.end") - F.col("span.start")).cast("int"))
    line = F.substring_index(F.col("part"), "\n", 1)
    return each.select(
        "conv_id", "pos",
        unescape_role(F.substring(line, F.lit(len(START) + 1), F.length(line))).alias("role"),
        unescape(F.substring(F.col("part"), F.length(line) + 2, F.length("part"))).alias("text"),
        unescape(marked).alias("loss_text"),
    )


def digests(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from the output: counts and SHA-256 of turns and of loss text."""
    turns = read_back(rendered).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "text", "loss_text"))).alias("t")
    )
    body = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("t", lambda x: x["loss_text"]), "")
    read = turns.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(body, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
    )
    size = rendered.select(F.col("conv_id").alias("_id"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.join(size, read["conv_id"].eqNullSafe(size["_id"])).drop("_id")


def rows_as_events(conversations: DataFrame) -> DataFrame:
    """A table of turns (``conv_id, turn, role, text``) as an event log, one ``message`` per row.

    Rows that repeat a turn are turns of their own, ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        "conv_id", F.row_number().over(order).cast("long").alias("seq"), F.lit("message").alias("kind"),
        F.row_number().over(order).cast("long").alias("msg"), "role", "text",
    )
