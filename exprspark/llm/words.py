"""Words, code points and row keys as Column expressions, shared by the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters that are none of these six.
SPACES = " \t\n\x0b\f\r"
GAP = "[ \\x09-\\x0D]+"
LAST_ID = 2**63 - 1


def text_of(column: str = "text") -> Column:
    """The text, NULL read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def split_words(text: Column) -> Column:
    """All words in order; an empty array where there are none."""
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(trimmed != "", F.split(trimmed, GAP)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """How many words a text has, without building them."""
    return F.regexp_count(text, F.lit("[^ \\x09-\\x0D]+")).cast("long")


def doc_key(column: str = "doc_id") -> Column:
    """The id used for order: a row without an id comes last."""
    return F.coalesce(F.col(column), F.lit(LAST_ID))


def free_name(df: DataFrame, name: str) -> str:
    """A column name the table doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
