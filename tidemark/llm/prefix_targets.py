"""Chat formatting: every assistant turn becomes an example of its own.

An example has all preceding turns as context, and only its reply is trainable. As contexts
are prefixes of one rendering, a conversation is rendered once and an example is a pair of
offsets into it: the end of its text and the span of the reply. So ``n`` turns make ``n``
rows, not ``n`` growing copies; ``texts`` cuts the literal examples out where they are wanted.
Turns after the last reply (all turns, if there is none) form a closing example without
anything trainable, so that no turn is lost.

A turn is rendered as ``<|turn|>role``, a new line, its text and ``<|end|>`` with a new line.
Control strings inside roles and texts (of this template and of common others) get a
backslash after their first character, backslashes are doubled, and new lines in roles
become ``<|line|>``; ``turns_of`` undoes all of it.

Defined cases: a null text or role is empty; null turns come first; equal turns are ordered
by role and text; repeated turns are kept; a null conversation id is a conversation. An empty
table gives none. A conversation must fit a row, as its rendering is one. Other columns are
neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END, LINE = "<|turn|>", "<|end|>", "<|line|>"
#: Control strings of chat templates, fixed values; all start with < or [.
CONTROLS = (
    TURN, END, LINE, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]",
)
_RESTS = "|".join(sorted({c[1:].replace("|", r"\|").replace("]", r"\]") for c in CONTROLS}))
ESCAPE, UNESCAPE = rf"([<\[])({_RESTS})", rf"([<\[])\\({_RESTS})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), ESCAPE, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, UNESCAPE, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def rendered_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: its rendering, and the offsets (code points) of turn and text."""
    blank = F.lit("")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    head = F.concat(F.lit(TURN), F.replace(escaped(role), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .withColumn("head", head)
        .withColumn("body", escaped(F.col("text")))
        .withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
        .withColumn("end", F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("replies_left", F.sum((F.col("role") == "assistant").cast("long")).over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("later", F.count("*").over(order.rowsBetween(1, Window.unboundedFollowing)))
        .withColumn("start", F.col("end") - F.length("piece"))
        .withColumn("loss_start", F.col("start") + F.length("head"))
        .withColumn("loss_end", F.col("loss_start") + F.length("body"))
        .select("conv_id", "role", "piece", "start", "end", "loss_start", "loss_end", "replies_left", "later")
    )


def formatted(conversations: DataFrame) -> DataFrame:
    """``conv_id, text, examples``: the rendering, and ``(end, loss_start, loss_end)`` by example.

    The text of an example is ``substring(text, 1, end)``; its loss mask is the code points
    from ``loss_start`` up to ``loss_end`` (counted from 0), and empty for a closing example.
    """
    reply = F.col("role") == "assistant"
    closing = ~reply & (F.col("replies_left") == 0) & (F.col("later") == 0)
    spans = F.when(reply, F.struct("end", "loss_start", "loss_end")).when(
        closing, F.struct("end", F.col("end").alias("loss_start"), F.col("end").alias("loss_end"))
    )
    pieces = F.sort_array(F.collect_list(F.struct("start", "piece")))
    return (
        rendered_turns(conversations)
        .groupBy("conv_id")
        .agg(
            F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("text"),
            F.sort_array(F.collect_list(spans)).alias("examples"),  # nulls are not collected
        )
    )


def texts(conversations: DataFrame) -> DataFrame:
    """One row per example: ``conv_id, example, text, loss_start, loss_end``."""
    return (
        formatted(conversations)
        .select("conv_id", F.col("text").alias("all"), F.posexplode("examples").alias("example", "span"))
        .select(
            "conv_id",
            "example",
            F.substring(F.col("all"), F.lit(1), F.col("span.end").cast("int")).alias("text"),
            "span.loss_start",
            "span.loss_end",
        )
    )


def turns_of(text: Column) -> Column:
    """The turns (role, text) read back from a rendering."""
    chunks = F.split(text, r"<\|turn\|>")

    def turn(chunk: Column) -> Column:
        role = F.substring_index(chunk, "\n", 1)
        body = F.substring(chunk, F.length(role) + 2, F.length(chunk) - F.length(role) - len(END) - 2)
        return F.struct(
            unescaped(F.replace(role, F.lit(LINE), F.lit("\n"))).alias("role"), unescaped(body).alias("text")
        )

    return F.transform(F.slice(chunks, F.lit(2), F.size(chunks)), turn)


def trained_text() -> Column:
    """The text under the loss mask of an example of ``texts``, unescaped."""
    return unescaped(
        F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    )


def loss_text(text: Column, examples: Column) -> Column:
    """All text under the loss masks of ``formatted``, unescaped, nothing between."""
    cut = lambda e: unescaped(
        F.substring(text, (e["loss_start"] + 1).cast("int"), (e["loss_end"] - e["loss_start"]).cast("int"))
    )
    return F.array_join(F.transform(examples, cut), "")
