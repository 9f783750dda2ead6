"""Chat formatting with one training example per assistant turn.

``format_turns`` renders a conversation once. ``examples`` explodes it: the example of an assistant turn
is the rendered text up to the end of that turn, with all turns before it as context, and only that
reply under the loss mask. ``read_back`` undoes the rendering.

A turn is ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts ``\\`` becomes ``\\\\`` and then
``<|`` becomes ``<\\|``: no marker is left, and undoing both in reverse order gives the text again.

Null roles and texts count as empty. Rows go by turn (null first); rows of equal turn by role and text,
so repeated rows stay, side by side. A null conversation id is a conversation. Conversations without an
assistant have no example. Empty tables give empty results; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.text import let, or_empty

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(text: Column) -> Column:
    doubled = F.replace(or_empty(text), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    marked = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(marked, F.lit("\\\\"), F.lit("\\"))


def format_turns(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """(conv_id, formatted, replies): a row per conversation; ``replies`` (n, start, end) of ``trained``.

    ``n`` is the reply's place among all turns; ``start`` and ``end`` hold its escaped text in
    ``formatted``, in code points. Places come from a running sum over sorted rows, so that a long
    conversation costs in proportion to its length.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        or_empty(F.col(role)).alias("role"),
        or_empty(F.col(text)).alias("text"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rendered = (
        rows.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
        .withColumn("body", escape(F.col("text")))
        .withColumn("n", F.row_number().over(in_order))
        .withColumn("chars", F.length("head") + F.length("body") + len(END))
        .withColumn(
            "before",
            F.sum("chars").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("chars"),
        )
    )
    start = F.col("before") + F.length("head")
    parts = F.sort_array(
        F.collect_list(F.struct("n", F.concat("head", "body", F.lit(END)).alias("part")))
    )
    reply = F.struct("n", start.alias("start"), (start + F.length("body")).alias("end"))
    return rendered.groupBy("conv_id").agg(
        F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("role") == trained, reply))).alias("replies"),
    )


def examples(formatted: DataFrame, *keep: str) -> DataFrame:
    """(conv_id, n, text, loss_start, loss_end) and the columns ``keep``: a row per reply.

    Example texts of a conversation add up to the square of its length. They are cut from ``formatted``
    row by row and need no shuffle; write them out only if the trainer wants them so.
    """
    return formatted.select(
        "conv_id", "formatted", *keep, F.explode_outer("replies").alias("reply")
    ).select(
        "conv_id",
        *keep,
        F.col("reply.n").alias("n"),
        F.substring("formatted", F.lit(1), (F.col("reply.end") + len(END)).cast("int")).alias("text"),
        F.col("reply.start").alias("loss_start"),
        F.col("reply.end").alias("loss_end"),
    )


def loss_text(text: Column, start: Column, end: Column) -> Column:
    return unescape(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    turns = let(F.split(formatted, r"<\|turn\|>"), lambda t: F.slice(t, F.lit(2), F.size(t)))

    def of(turn: Column) -> Column:
        role, rest = F.split_part(turn, F.lit(TEXT), F.lit(1)), F.split_part(turn, F.lit(TEXT), F.lit(2))
        body = F.substring(rest, F.lit(1), F.length(rest) - len(END))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, of)


def digests(formatted: DataFrame) -> DataFrame:
    """What the contract asks for, read back from formatted conversations and their examples."""
    turns = read_back(F.col("formatted"))
    said = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    whole = formatted.select(
        "conv_id",
        "formatted",
        "replies",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    kept = ("n_turns", "turns_sha256", "formatted_chars")
    cut = examples(whole, *kept).select(
        "conv_id",
        *kept,
        "n",
        F.length("text").cast("long").alias("chars"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
    )
    joined = F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("n", "loss")))),
            lambda x: x["loss"],
        ),
        "",
    )
    return cut.groupBy("conv_id").agg(
        *[F.first(c).alias(c) for c in kept],
        joined.alias("loss"),
        F.count("n").alias("n_examples"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("example_chars"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
        "example_chars",
    )
