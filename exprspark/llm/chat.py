"""Chat formatting with a grammar that is parsed back, in Column expressions only.

A conversation is a row of turns::

    ### role: text
    </turn>

A turn ends at the first line break, ``</turn>`` and line break. In a text, a control string (``### `` or ``</turn>``)
with any backslashes before it gets one backslash more, and the parser takes one away from each; so escaped text shows
no mark, and every text, also one that looks escaped, comes back. Colons, line breaks and percent signs of a role are
written as percent and two hexadecimal digits.

Texts are first rendered as they are and parsed again; only those that don't come back identical, or that show a
control string, are escaped. One such round is enough, since taking one backslash away undoes adding one; nevertheless
the whole conversation is parsed and compared with its source, and a difference fails the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exprspark.llm.words import text_of

HEAD, END = "### ", "\n</turn>\n"
MARK = "(### |</turn>)"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    """One more backslash before each control string and the backslashes in front of it."""
    return F.regexp_replace(text, rf"(\\*){MARK}", r"\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*){MARK}", "$1$2")


def written_role(role: Column) -> Column:
    for sign, code in (("%", "%25"), (":", "%3A"), ("\n", "%0A")):
        role = F.replace(role, F.lit(sign), F.lit(code))
    return role


def read_role(role: Column) -> Column:
    for sign, code in (("\n", "%0A"), (":", "%3A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(sign))
    return role


def rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(": "), body, F.lit(END))


def blocks_of(formatted: Column) -> Column:
    """The turns of a formatted conversation as they stand there, without their ends."""
    pieces = F.split(formatted, r"\n</turn>\n", -1)
    return F.slice(pieces, F.lit(1), F.size(pieces) - 1)


def turn_of(block: Column) -> Column:
    """``role, body`` of one turn; the body is still escaped."""
    role = F.regexp_extract(block, "^### ([^:]*): ", 1)
    body = F.substring(block, F.length(role) + len(HEAD) + 3, F.length(block))
    return F.struct(role.alias("role"), body.alias("body"))


def parsed(formatted: Column) -> Column:
    """``role, text`` of each turn, as they were before formatting."""
    turns: Callable[[Column], Column] = lambda b: F.struct(
        read_role(turn_of(b)["role"]).alias("role"), unescaped(turn_of(b)["body"]).alias("text")
    )
    return F.transform(blocks_of(formatted), turns)


def without_conflict(text: Column) -> Column:
    """The text itself if it shows no control string and comes back from a turn of its own, else escaped."""
    alone = parsed(rendered(F.lit("user"), text))
    fine = ~F.contains(text, F.lit(HEAD)) & ~F.contains(text, F.lit("</turn>"))
    # Parsing is for the texts that a plain search can't clear.
    same = (F.size(alone) == 1) & (F.get(alone, F.lit(0))["text"] == text)
    return F.when(fine, text).when(~F.rlike(text, F.lit(MARK)) & same, text).otherwise(escaped(text))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``: each conversation as one text, and where the assistant's texts stand in it.

    ``loss`` lists ``start, length`` in code points of ``formatted``, with the number of the turn, from 0, and where the
    text begins in that turn's block. Turns are ordered by ``turn`` (NULL last), then role and text, so
    ties and repeated rows have a place each. A NULL text or role is empty; rows without ``conv_id`` are one
    conversation; an empty table gives an empty result; other columns play no part. A conversation is one value in the
    result and is put together in one task.
    """
    rows = turns.select(
        "conv_id", F.col("turn").isNull().alias("last"), "turn", F.coalesce("role", F.lit("")).alias("role"), text_of().alias("text")
    )
    rows = rows.select("*", written_role(F.col("role")).alias("shown"), without_conflict(F.col("text")).alias("body"))
    rows = rows.withColumn("block", rendered(F.col("shown"), F.col("body")))
    order = Window.partitionBy("conv_id").orderBy("last", "turn", "role", "text")
    placed = rows.select(
        "conv_id", "role", "text", "block", F.row_number().over(order).alias("at"), F.length("body").cast("long").alias("length"),
        (F.sum(F.length("block").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))).alias("before"),
        F.length("shown").cast("long").alias("wide"),
    )
    inside = F.col("wide") + len(HEAD) + 2
    start = F.coalesce(F.col("before"), F.lit(0)).cast("long") + inside
    entry = F.struct("at", "block", "role", "text", start.alias("start"), "length", inside.alias("inside"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    whole = whole.select("conv_id", "turns", F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    checked = F.when(parsed(F.col("formatted")) == source, F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("a formatted conversation doesn't read back: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("without id"))))
    )
    learned = F.transform(
        F.filter("turns", lambda t: t["role"] == LEARNED), lambda t: F.struct(
            t["start"].alias("start"), t["length"].alias("length"), (t["at"] - 1).alias("turn"), t["inside"].alias("inside")
        )
    )
    return whole.select("conv_id", checked.alias("formatted"), learned.alias("loss"))


def masked(blocks: Column, loss: Column) -> Column:
    """The texts under the mask, unescaped, one after another; ``blocks`` are those of the formatted text."""

    def cut(span: Column) -> Column:
        return F.substring(F.get(blocks, span["turn"]), (span["inside"] + 1).cast("int"), span["length"].cast("int"))

    return F.array_join(F.transform(loss, lambda s: unescaped(cut(s))), "")
