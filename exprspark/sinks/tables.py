"""Sinks: canonical count tables, result tables, JSON records and text selections. None overwrites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.functions.text import quote, quoted
from exprspark.operators.counts import to_wide

WHITESPACE_KEPT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_counts(matrix: DataFrame, sample_ids: list[str], path: str) -> None:
    """Gene rows in byte order, samples in the given order, one header per part file.

    Genes are ranged over tasks, so parts are globally sorted by name. Only cells that would not read
    back bare are quoted.
    """
    wide = to_wide(matrix, sample_ids).orderBy("gene_id")
    cells = [quote(F.col("gene_id"))] + [F.col(f"`{s}`").cast("string") for s in sample_ids]
    lines = wide.select(F.concat_ws("\t", *cells).alias("gene_id"))
    header = "\t".join(["gene_id", *sample_ids])
    (
        lines.withColumnRenamed("gene_id", header)
        .write.mode("errorifexists")
        .option("header", True)
        .option("sep", "\x01")
        .option("quote", "")
        .options(**WHITESPACE_KEPT)
        .csv(path)
    )


def write_results(table: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Quoted text, literal NA for NULL; partitioned by contrast when asked."""
    writer = table.write.mode("errorifexists").options(**WHITESPACE_KEPT)
    writer = writer.option("header", True).option("sep", "\t").option("quoteAll", True)
    writer = writer.option("escape", '"').option("nullValue", "NA").option("emptyValue", "")
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_matrix(rows: DataFrame, keys: list[str], values: str, names: list[str], path: str, order: list[str] | None = None) -> None:
    """Packed rows as a wide table: quoted keys, then a cell per name from the array ``values``, NA for NULL.

    A row is one text rendered from its array, so nothing is pivoted and the plan does not grow with the names. Without
    rows the header stands alone. A row of another length, or a key the format can't hold, fails the job.
    """
    key = [F.col(f"`{k}`").cast("string") for k in keys]
    cells = F.transform(values, lambda v: F.coalesce(v.cast("string"), F.lit("NA")))
    line = F.concat_ws("\t", F.concat_ws("\t", *[F.coalesce(quoted(k), F.lit("NA")) for k in key]), cells)
    broken = reduce(lambda a, b: a | b, [F.coalesce(k.rlike("[\t\r\n]"), F.lit(False)) for k in key])
    ragged = F.coalesce(F.size(values), F.lit(-1)) != len(names)
    checked = F.when(ragged, F.raise_error(F.lit(f"a row without one value per name in {path}")).cast("string")).when(
        broken, F.raise_error(F.lit(f"a key with a tab or line break in {path}")).cast("string")
    ).otherwise(line)
    heads = [*keys, *names]
    if any(c in h for h in heads for c in "\t\r\n"):
        raise ValueError("a column name with a tab or line break")
    header = "\t".join('"' + h.replace('"', '""') + '"' for h in heads)
    placed = rows.orderBy(*order) if order else rows
    bare = {"sep": "\x01", "quote": "", "header": True, **WHITESPACE_KEPT}
    placed.select(checked.alias(header)).write.mode("errorifexists").options(**bare).csv(path)


def write_records(table: DataFrame, path: str) -> None:
    table.write.mode("errorifexists").json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("errorifexists").text(path)


def write_cohorts(cohorts: DataFrame, path: str) -> None:
    cohorts.write.mode("errorifexists").partitionBy("cohort").parquet(path)
