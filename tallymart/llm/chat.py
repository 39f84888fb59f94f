"""Chat formatting by event-sourced reconstruction, with built-in functions only.

A conversation log holds events ``(conv_id, message, seq, kind, role, text)``:

``open``        a message begins; its role and first text
``delta``       streamed text, appended
``edit``        the text so far is replaced
``regenerate``  the text so far is thrown away

The log is partitioned by conversation and message, sorted by seq and folded; only what
follows the last ``open``, ``edit`` or ``regenerate`` (that event's own text included) is
left. ``message`` is ``(turn, copy)``: copies are equal rows of one turn.

Messages are rendered in parts of up to 32 turn numbers, so that a conversation of any
length is never in one task while it is built; its text is its parts in order:

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Texts are escaped by ``\\`` before ``\\`` and inside ``<|``, so no text can hold a control
string; ``read_back`` undoes it. Line breaks in roles are escaped as well. The loss mask is
a list of spans ``(start, length)`` of the assistant texts in a part, in code points.

A null text or role is empty. Rows of one turn are ordered by role and text. A null turn
comes first, a null conv_id is a conversation of its own. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 32
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<|n|>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|n|>"), F.lit("\n")))


def messages(events: DataFrame) -> DataFrame:
    """Fold each message's events into its final role and text."""
    log = F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text")))
    logs = events.groupBy("conv_id", "message").agg(log.alias("log"))
    resets = F.array_max(
        F.transform("log", lambda e, i: F.when(e.kind != "delta", i).otherwise(F.lit(0)))
    )
    last = F.slice("log", resets + 1, F.size("log"))
    return logs.select(
        "conv_id",
        "message",
        F.coalesce(F.array_max(F.transform("log", lambda e: F.when(e.kind == "open", e.role))), F.lit("")).alias("role"),
        F.array_join(F.transform(last, lambda e: F.coalesce(e.text, F.lit(""))), "").alias("text"),
    )


def render(final: DataFrame) -> DataFrame:
    """``(conv_id, part, formatted, loss_spans)`` of ``final(conv_id, message, role, text)``."""
    row = F.struct(
        F.col("message.turn").alias("turn"), "role", "text", F.col("message.copy").alias("copy")
    )
    parts = final.groupBy("conv_id", F.floor(F.col("message.turn") / PART_TURNS).alias("part")).agg(
        F.sort_array(F.collect_list(row)).alias("rows")
    )
    head = lambda r: F.concat(F.lit(START), escape_role(r.role), F.lit("\n"))
    parts = parts.select(
        "conv_id",
        "part",
        F.transform(
            "rows", lambda r: F.struct(r.role.alias("role"), head(r).alias("head"), escape(r.text).alias("body"))
        ).alias("rows"),
    )
    tail = f"{END}\n"
    none = F.array().cast("array<struct<start:int,length:int>>")

    def step(acc: Column, r: Column) -> Column:
        at, n = acc.at + F.length(r.head), F.length(r.body)
        span = F.when(r.role == LOSS_ROLE, F.array(F.struct(at.alias("start"), n.alias("length")))).otherwise(none)
        return F.struct((at + n + len(tail)).alias("at"), F.concat(acc.spans, span).alias("spans"))

    return parts.select(
        "conv_id",
        "part",
        F.array_join(F.transform("rows", lambda r: F.concat(r.head, r.body, F.lit(tail))), "").alias("formatted"),
        F.aggregate("rows", F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc.spans).alias("loss_spans"),
    )


def read_back(parts: DataFrame) -> DataFrame:
    """Turns and loss texts of each part, from the formatted text and its mask alone."""
    blocks = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, 1 << 30)
    body = lambda b: F.substring_index(F.substring(b, F.instr(b, "\n") + 1, F.length(b)), END, 1)
    turn = lambda b: F.struct(
        unescape_role(F.substring_index(b, "\n", 1)).alias("role"), unescape(body(b)).alias("text")
    )
    return parts.select(
        "conv_id",
        "part",
        F.transform(blocks, turn).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s.start + 1, s.length))).alias("losses"),
        F.length("formatted").alias("formatted_chars"),
    )


def log_of(rows: DataFrame, piece: int = 400) -> DataFrame:
    """An event log whose fold is ``rows(conv_id, turn, role, text)``.

    Every message is streamed in pieces; by its hash a quarter of them is drafted and then
    regenerated, and a quarter is drafted and then edited.
    """
    text = F.coalesce("text", F.lit(""))
    counted = rows.groupBy("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text")).count()
    message = F.struct("turn", F.xxhash64("role", "text").alias("of"), "copy").alias("message")
    one = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    starts = F.sequence(F.lit(0), F.floor((F.length("text") + piece - 1) / piece).cast("int"))
    event = lambda kind, body: F.struct(F.lit(kind).alias("kind"), body.alias("text"))
    deltas = F.transform(starts, lambda i: event("delta", F.substring("text", i * piece + 1, F.lit(piece))))
    draft = event("delta", F.concat(F.lit("draft of "), F.substring("text", F.lit(1), F.lit(20))))
    way = F.pmod(F.xxhash64("text", "conv_id"), F.lit(4))
    events = (
        F.when(way == 0, F.concat(F.array(draft, event("regenerate", F.lit(""))), deltas))
        .when(way == 1, F.array(draft, event("edit", F.col("text"))))
        .otherwise(deltas)
    )
    events = F.concat(F.array(event("open", F.lit(""))), events)
    return one.select("conv_id", message, "role", F.posexplode(events).alias("seq", "e")).select(
        "conv_id", "message", "seq", F.col("e.kind").alias("kind"), "role", F.col("e.text").alias("text")
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    return render(messages(log_of(rows)))
