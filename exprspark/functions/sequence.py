"""Scalar functions on reads, alignments and intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Read alphabets and alignment flag bits.
BASES_PATTERN = r"\A[ACGTNacgtn]+\z"
QUALITY_PATTERN = r"\A[!-~]+\z"
FLAG_UNMAPPED = 4
FLAG_REVERSE = 16
FLAG_SECOND = 128
FLAG_SECONDARY = 256
FLAG_SUPPLEMENTARY = 2048
NOT_PRIMARY = FLAG_UNMAPPED + FLAG_SECONDARY + FLAG_SUPPLEMENTARY


def is_sequence(c: Column) -> Column:
    return F.coalesce(c.rlike(BASES_PATTERN), F.lit(False))


def is_quality(c: Column) -> Column:
    return F.coalesce(c.rlike(QUALITY_PATTERN), F.lit(False))


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGT", "TGCA"))


def phred_scores(quality: Column) -> Column:
    """Quality letters as integers, letter code minus 33."""
    return F.transform(F.split(quality, ""), lambda q: F.ascii(q) - 33)


def phred_error(score: Column) -> Column:
    return F.pow(F.lit(10.0), -score.cast("double") / 10.0)


# A letter's error probability, by its code.
ERRORS = np.array([10.0 ** (-(code - 33) / 10.0) for code in range(128)])
LETTERS_AT_ONCE = 1 << 16


def letter_sums(text: str | None) -> tuple[int, float] | None:
    """Score sum and expected errors of one quality text; the letters are added in order, a bounded run at once."""
    if text is None:
        return None
    codes = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    codes = codes if len(codes) else np.zeros(1, np.uint8)  # the empty text is one letter of code zero, as for split
    total, errors = 0, 0.0
    for low in range(0, len(codes), LETTERS_AT_ONCE):
        run = codes[low: low + LETTERS_AT_ONCE]
        total += int(run.sum(dtype=np.int64)) - 33 * len(run)
        chances = ERRORS[run] if run.dtype == np.uint8 else 10.0 ** (-(run.astype(float) - 33) / 10.0)
        errors = float(np.cumsum(np.concatenate(([errors], chances)))[-1])
    return total, errors


def phred_sums(quality: Column) -> Column:
    """Score sum and expected errors of quality texts, ``struct<score_sum,expected_errors>``.

    The sums of ``phred_scores`` and ``phred_error`` without an array element per letter.
    """

    def sums(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("score_sum", pa.int64()), ("expected_errors", pa.float64())])
        for batch in texts:
            found = [letter_sums(text.as_py()) for text in batch]
            yield pa.array([f and dict(zip(("score_sum", "expected_errors"), f)) for f in found], kind)

    return F.arrow_udf(sums, "score_sum long, expected_errors double")(quality)


def has_flag(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def is_primary(flag: Column) -> Column:
    return ~has_flag(flag, NOT_PRIMARY)


def tag_values(fields: Column, tag: str) -> Column:
    """All values of one optional alignment field, normally one element."""
    kept = F.filter(fields, lambda f: f.startswith(tag))
    return F.transform(kept, lambda f: F.substring(f, F.lit(len(tag) + 1), F.length(f)))


def is_spliced(cigar: Column) -> Column:
    return cigar.contains("N")


def cigar_blocks(position: Column, cigar: Column) -> Column:
    """Reference blocks (1-based, inclusive) that an alignment covers, as ``array<struct<start,end>>``.

    Operations that use no reference are dropped, then the text is cut at each skip N. A piece such as
    ``37M200`` keeps its covered lengths and, last, the length of the skip behind it; the final piece has
    none. The two common shapes, one match and two matches around one skip, take a short way by pattern.
    """
    at = position.cast("int")
    block = "array<struct<start:int,end:int>>"
    lengths = F.split(F.regexp_replace(cigar, "[0-9]+[ISHP]", ""), "N")
    pieces = F.transform(
        lengths, lambda piece: F.transform(F.split(piece, "[MDX=]"), lambda n: F.coalesce(n.try_cast("int"), F.lit(0)))
    )

    def step(acc: Column, piece: Column) -> Column:
        whole = F.aggregate(piece, F.lit(0), lambda a, n: a + n)
        ahead = acc["at"] + whole
        end = ahead - F.element_at(piece, -1) - 1
        here = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        done = F.when(end >= acc["at"], F.concat(acc["done"], here)).otherwise(acc["done"])
        return F.struct(ahead.alias("at"), done.alias("done"))

    start = F.struct(at.alias("at"), F.array().cast(block).alias("done"))
    general = F.aggregate(pieces, start, step, lambda acc: acc["done"])
    one, two = r"\A[0-9]+M\z", r"\A[0-9]+M[0-9]+N[0-9]+M\z"

    def cut(text: Column, mark: str, i: int) -> Column:
        return F.split_part(text, F.lit(mark), F.lit(i))

    def matched(i: int) -> Column:
        return cut(cigar, "M", 1).cast("int") if i == 1 else cut(cut(cigar, "M", 2), "N", i - 1).cast("int")

    def span(start: Column, length: Column) -> Column:
        return F.struct(start.alias("start"), (start + length - 1).alias("end"))

    second = at + matched(1) + matched(2)
    return (
        F.when(cigar.rlike(one), F.array(span(at, matched(1))))
        .when(cigar.rlike(two), F.array(span(at, matched(1)), span(second, matched(3))))
        .otherwise(general)
        .cast(block)
    )


def parse_intervals(c: Column) -> Column:
    """``264-300,501-538`` as an array of (start, end)."""
    return F.transform(
        F.split(c, ","),
        lambda part: F.struct(
            F.split_part(part, F.lit("-"), F.lit(1)).cast("int").alias("start"),
            F.split_part(part, F.lit("-"), F.lit(2)).cast("int").alias("end"),
        ),
    )


def gtf_attribute(attributes: Column, key: str) -> Column:
    """Value of one quoted attribute, empty when it is absent."""
    return F.regexp_extract(attributes, rf'(?:^|; ){key} "([^"]*)";', 1)
