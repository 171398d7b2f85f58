"""Scalar grammar: identifiers, strict numbers, cells, digests and labels, all as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted grammars and the unsigned 64-bit bound.
ID_PATTERN = r"\A[A-Za-z0-9][A-Za-z0-9_.-]*\z"
IDENTIFIER_PATTERN = r"\A[A-Za-z][A-Za-z0-9_]*\z"
DECIMAL_PATTERN = r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
UINT_PATTERN = r"\A[0-9]+\z"
SHA256_PATTERN = r"\A[0-9A-Fa-f]{64}\z"
ACCESSION_PATTERN = r"SRX[0-9]+"
UINT64_MAX = 18446744073709551615
INT32_MAX = 2147483647
DOUBLE_TINY = 2.2250738585072014e-308
BOM = "\ufeff"
BLANKS = " \t\r\n"

COUNT_TYPE = "decimal(20,0)"


def valid_id(c: Column) -> Column:
    return F.coalesce(c.rlike(ID_PATTERN), F.lit(False))


def valid_identifier(c: Column) -> Column:
    return F.coalesce(c.rlike(IDENTIFIER_PATTERN), F.lit(False))


def valid_digest(c: Column) -> Column:
    return F.coalesce(c.rlike(SHA256_PATTERN), F.lit(False))


def uint64_value(c: Column) -> Column:
    """Digits only, at most 2**64 - 1; NULL for anything else. Leading zeros are allowed."""
    wide = F.when(c.rlike(UINT_PATTERN), c.try_cast("decimal(38,0)"))
    return F.when(wide <= F.lit(str(UINT64_MAX)).cast("decimal(38,0)"), wide).cast(COUNT_TYPE)


def decimal_value(c: Column) -> Column:
    """A finite decimal as double, NULL for anything the grammar or the double range excludes.

    A non-zero literal that underflows to zero is out of range too.
    """
    number = F.when(c.rlike(DECIMAL_PATTERN), c.try_cast("double"))
    significand = F.regexp_extract(c, r"\A[^eE]*", 0)
    underflow = (number == 0) & significand.rlike("[1-9]")
    return F.when((F.abs(number) < F.lit(float("inf"))) & ~underflow, number)


def valid_text(c: Column) -> Column:
    return F.is_valid_utf8(c) & ~c.contains(BOM)


def cell_is_closed(cell: Column) -> Column:
    """True when a cell is bare without quotes, or fully quoted with inner quotes doubled."""
    inner = F.substring(cell, F.lit(2), F.greatest(F.length(cell) - 2, F.lit(0)))
    quoted = (
        (F.length(cell) >= 2)
        & cell.endswith('"')
        & ~F.replace(inner, F.lit('""'), F.lit("")).contains('"')
    )
    return F.when(cell.startswith('"'), quoted).otherwise(~cell.contains('"'))


def unquote(cell: Column) -> Column:
    inner = F.substring(cell, F.lit(2), F.greatest(F.length(cell) - 2, F.lit(0)))
    return F.when(cell.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def quote(value: Column) -> Column:
    """Quote only what would not read back bare: a leading comment mark or an embedded quote."""
    needs = value.startswith("#") | value.contains('"')
    return F.when(needs, quoted(value)).otherwise(value)


def split_terms(c: Column) -> Column:
    return F.split(c, ",", -1)


def lower_hex(c: Column) -> Column:
    return F.lower(c)


def before(c: Column, mark: str) -> Column:
    """Text up to the first mark, the whole text without one."""
    return F.substring_index(c, mark, 1)


def after(c: Column, mark: str) -> Column:
    """Text behind the first mark, empty without one."""
    at = F.instr(c, mark)
    return F.when(at > 0, F.substring(c, at + len(mark), F.length(c))).otherwise(F.lit(""))


def title_condition(title: Column) -> Column:
    return F.split_part(title, F.lit("-"), F.lit(1))


def title_count_column(title: Column, prefixes: dict[str, str]) -> Column:
    """Map a title such as ``group-4`` to its count column, one prefix per group."""
    group = title_condition(title)
    number = F.split_part(title, F.lit("-"), F.lit(2))
    known = reduce(
        lambda acc, item: acc.when(group == item[0], F.concat(F.lit(item[1]), number)),
        list(prefixes.items())[1:],
        F.when(group == next(iter(prefixes)), F.concat(F.lit(next(iter(prefixes.values()))), number)),
    )
    return known


def accession(c: Column) -> Column:
    found = F.regexp_extract(c, ACCESSION_PATTERN, 0)
    return F.when(found != "", found)


def neg_log10(p: Column) -> Column:
    """``-log10`` with zero held at the smallest normal double; NULL stays NULL."""
    return F.when(p.isNotNull(), -F.log10(F.greatest(p, F.lit(DOUBLE_TINY))))


def syntactic_name(c: Column) -> Column:
    """Make a model-column name: odd characters become dots, and a name must not start with a digit."""
    dotted = F.regexp_replace(c, r"[^\p{L}\p{Nd}._]", ".")
    needs_x = ~dotted.rlike(r"\A(\p{L}|\.(?![0-9]))")
    return F.when(needs_x, F.concat(F.lit("X"), dotted)).otherwise(dotted)


def coefficient_name(factor: Column, numerator: Column, denominator: Column) -> Column:
    return syntactic_name(F.concat(factor, F.lit("_"), numerator, F.lit("_vs_"), denominator))


def plain_path(uri: Column) -> Column:
    """A file URI as the path a manifest would name."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def resolve_path(source: Column, value: Column) -> Column:
    """A manifest's relative path, taken from the manifest's own folder."""
    joined = F.concat(folder_of(source), F.lit("/"), value)
    absolute = value.startswith("/") | value.rlike("^[a-z][a-z0-9+.-]*:/")
    return F.when(value == "", F.lit(None).cast("string")).when(absolute, value).otherwise(joined)
