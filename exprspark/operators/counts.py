"""Technical-run merge, matrix shape, filters, annotation and ordered output of count matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.functions.text import UINT64_MAX


WORD = 4294967296


def merge_runs(counts: DataFrame, runs: DataFrame) -> DataFrame:
    """Sum ``counts(run_id, gene_id, count)`` into ``(gene_id, sample_id, count)``.

    Partial sums run before the only wide shuffle, so a hot gene or sample is reduced where it is read.
    A sum past the unsigned 64-bit range fails the job. Counts are summed as two 32-bit halves in plain
    longs, which neither overflow nor need wide decimals before the last step.
    """
    c = F.col("count")
    if dict(counts.dtypes)["count"].startswith("decimal"):
        low = (c % WORD).cast("bigint")
        high = ((c - c % WORD) / WORD).cast("bigint")
    else:
        low, high = c.bitwiseAND(F.lit(WORD - 1)), F.shiftright(c, 32)
    mapped = counts.join(runs.select("run_id", "sample_id"), "run_id")
    halves = mapped.groupBy("gene_id", "sample_id").agg(F.sum(low).alias("low"), F.sum(high).alias("high"))
    return halves.select("gene_id", "sample_id", checked_total(F.col("low"), F.col("high")).alias("count"))


def checked_total(low: Column, high: Column) -> Column:
    """The two half sums as one decimal; a total that is small stays in longs until its last cast."""
    wide = high.cast("decimal(20,0)") * F.lit(WORD).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    over = wide > F.lit(str(UINT64_MAX)).cast("decimal(20,0)")
    overflow = F.raise_error(F.concat(F.lit("count sum exceeds uint64: "), wide.cast("string")))
    large = F.when(over, overflow.cast("decimal(20,0)")).otherwise(wide.cast("decimal(20,0)"))
    return F.when(high == 0, low.cast("decimal(20,0)")).otherwise(large)


def gene_totals(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("gene_id").agg(F.sum("count").alias("total"))


def drop_zero_total(matrix: DataFrame) -> DataFrame:
    """Keep genes with any count. A gene qualifies by one non-zero cell, so no sum is needed."""
    kept = matrix.filter(F.col("count") > 0).select("gene_id").distinct()
    return matrix.join(kept, "gene_id", "left_semi")


def to_wide(matrix: DataFrame, sample_ids: list[str]) -> DataFrame:
    """Gene rows, one column per sample in the given order; missing cells become zero, a cell of another sample fails the job."""
    told = F.concat(F.lit("count of a sample that is not listed: "), F.coalesce("sample_id", F.lit("NULL")))
    listed = F.when(F.coalesce(F.col("sample_id").isin(sample_ids), F.lit(False)), F.col("sample_id")).otherwise(F.raise_error(told))
    wide = matrix.withColumn("sample_id", listed).groupBy("gene_id").pivot("sample_id", sample_ids).agg(F.sum("count"))
    return wide.select("gene_id", *[F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias(s) for s in sample_ids])


def dense(matrix: DataFrame, sample_ids: list[str], universe: DataFrame | None = None) -> DataFrame:
    """All gene x sample cells in long form, zero where nothing was counted.

    Cells are laid out by one pivot and unfolded again, so the grid is never built by a cross join.
    """
    wide = to_wide(matrix, sample_ids)
    if universe is not None:
        wide = universe.select("gene_id").join(wide, "gene_id", "left").na.fill(0)
    return wide.unpivot("gene_id", [F.col(f"`{s}`") for s in sample_ids], "sample_id", "count")


def pack(matrix: DataFrame, ordinals: DataFrame, value: str = "count") -> DataFrame:
    """One row per gene ``(gene_id, y, strangers)`` with its values as an array in sample order.

    An array is as long as the sample list. A gene with a missing or doubled cell has another length, and
    cells of unlisted samples are counted as ``strangers``; the model stage refuses both.
    """
    placed = matrix.join(ordinals.select("sample_id", "ordinal"), "sample_id", "left")
    known = F.col("ordinal").isNotNull()
    cell = F.when(known, F.struct("ordinal", F.col(value).cast("double").alias("v")))
    cells = F.sort_array(F.collect_list(cell))
    return placed.groupBy("gene_id").agg(
        F.transform(cells, lambda c: c["v"]).alias("y"), F.count_if(~known).alias("strangers")
    )


def annotate(table: DataFrame, annotation: DataFrame) -> DataFrame:
    """Left mapping by gene. Empty annotation text becomes NULL and the row count never changes."""
    columns = ["gene_symbol", "biotype", "chromosome"]
    mapping = annotation.select("gene_id", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in columns])
    return table.join(mapping, "gene_id", "left")


def project_cohort(matrix: DataFrame, members: DataFrame) -> DataFrame:
    """Select and rename count columns: ``members(count_column, sample_id)``, once per cohort if it has one."""
    return matrix.join(members, "count_column").drop("count_column")
