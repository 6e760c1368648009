"""Chat logs folded into conversations, rendered and read back.

A log holds events ``conv_id, seq, message, role, kind, text``:

* ``delta``       appends its text to the message,
* ``edit``        replaces everything the message said so far,
* ``regenerate``  discards it; its own text and later deltas start anew.

Events are ordered by ``seq``; at equal ``seq`` an edit or regeneration comes
first, then texts in their own order.  A message stands where its first event
stands.  Null text or role counts as empty, a null kind as ``delta``; null ids
are ids of their own.  A log without events gives no rows.

The template is ``<|role|>\\n`` text ``<|end|>\\n`` per turn.  In roles and
texts every character that starts or ends a control string (``< [ | \\``) gets
a backslash after it, so no control string of this or the usual bracket
templates can stand in a text, and removing those backslashes restores it.

Only DataFrame functions: events are spread by message first, so a long
conversation is folded by many tasks and only its final turns meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

END = "<|end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|\\])\\", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, first_seq, role, text."""
    kind = F.coalesce(F.col("kind"), F.lit("delta"))
    e = events.select(
        "conv_id",
        "message",
        "seq",
        F.coalesce("role", F.lit("")).alias("role"),
        kind.isin("edit", "regenerate").alias("resets"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    own = W.partitionBy("conv_id", "message")
    e = e.withColumn("cut", F.max(F.when(F.col("resets"), F.col("seq"))).over(own))
    e = e.withColumn("first_seq", F.min("seq").over(own))
    live = F.col("cut").isNull() | (F.col("seq") > F.col("cut")) | (F.col("resets") & (F.col("seq") == F.col("cut")))
    parts = F.array_sort(F.collect_list(F.struct("seq", (~F.col("resets")).alias("later"), "text", "role")))
    return (
        e.filter(live)
        .groupBy("conv_id", "message")
        .agg(F.min("first_seq").alias("first_seq"), parts.alias("parts"))
        .select(
            "conv_id",
            "message",
            "first_seq",
            F.col("parts")[0]["role"].alias("role"),
            F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, segments: the segments joined are the formatted text.

    ``segments`` is an array of (text, loss); training counts the loss of
    those marked true, the texts of ``loss_role`` without their marks.
    """
    turn = F.struct(
        "first_seq",
        "message",
        F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == loss_role).alias("loss"),
    )

    def pieces(t: Column) -> Column:
        return F.array(
            F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
            F.struct(t["body"].alias("text"), t["loss"].alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        )

    return (
        messages.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"))
        .select(
            "conv_id",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            "segments",
        )
    )


def turns_of(formatted: Column) -> Column:
    """Read rendered text back: an array of (role, text)."""
    blocks = F.split(formatted, r"<\|end\|>\n", -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)
    head = r"^<\|((?s).*?)\|>\n"
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape(F.regexp_extract(b, head, 1)).alias("role"),
            unescape(F.regexp_replace(b, head, "")).alias("text"),
        ),
    )


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescape(s["text"])), "")


def streamed(rows: DataFrame, delta_chars: int = 512) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text).

    Each turn opens with an empty delta and streams its text in pieces of at
    most ``delta_chars`` characters.  Turns stand by number, repeated numbers
    by role and text.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    deltas = F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0)))
    return (
        rows.select("conv_id", "turn", "role", "text", F.row_number().over(order).cast("long").alias("message"))
        .select("conv_id", "message", "role", F.posexplode(deltas).alias("part", "text"))
        .select(
            "conv_id",
            (F.col("message") * F.lit(1 << 32) + F.col("part")).alias("seq"),
            "message",
            "role",
            F.lit("delta").alias("kind"),
            "text",
        )
    )
