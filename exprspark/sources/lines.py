"""Text lines with their record number inside each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = ["source", "block_start", "block_length", "split_no"]


def raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line, in scan order inside each file block. A leading byte-order mark is dropped."""
    # monotonically_increasing_id holds the split in its upper 31 bits and the row position below.
    seq = F.monotonically_increasing_id()
    return (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("source"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.col("_metadata.file_block_length").alias("block_length"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("value").alias("text"),
            seq.alias("seq"),
        )
        .withColumn("split_no", F.shiftright("seq", 33))
    )


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines as ``(source, record, text, is_last)``; record 1 is the first physical line of a file."""
    return placed_lines(spark, paths).drop("block_first", "block_last")


def placed_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``numbered_lines`` with the first and last record of the file block a line was read in, in scan order.

    Two scans and no shuffle of the text: the first reduces each file block to its line count, a window
    over those few rows gives block offsets, and the second scan adds them. The offsets are broadcast, one row
    per file block: Spark sizes them by the text, and would shuffle and sort it for a join. Each block is read by one
    task, so its rows are contiguous in ``seq``. The split number is part of the lookup key: had the two
    scans been split differently, the lookup would miss and the job fails instead of misnumbering.

    ``is_last`` rows know whether a line feed ended the file, from the byte total; a carriage return is
    removed only where a line feed followed it.
    """
    raw = raw_lines(spark, paths)
    blocks = raw.groupBy(*BLOCK).agg(
        F.min("seq").alias("first_seq"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("text") + 1).alias("bytes"),
        F.first("file_size").alias("file_size"),
    )
    whole = Window.partitionBy("source")
    earlier = whole.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    compressed = F.col("source").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    # What the counted bytes leave over: a dropped 3-byte mark, minus one for a missing final line feed.
    left_over = F.col("file_size") - F.sum("bytes").over(whole)
    offsets = blocks.select(
        *BLOCK,
        "first_seq",
        "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"),
        F.sum("n").over(whole).alias("lines_total"),
        (compressed | left_over.isin(0, 3)).alias("ends_in_lf"),
    )
    found = F.when(F.col("first_seq").isNull(), F.raise_error(F.lit("file splits changed between scans")))
    record = F.coalesce(found.cast("long"), F.col("lines_before") + F.col("seq") - F.col("first_seq") + 1)
    is_last = F.col("record") == F.col("lines_total")
    return (
        raw.drop("file_size")
        .join(F.broadcast(offsets), BLOCK, "left")
        .withColumn("record", record)
        .select(
            "source",
            "record",
            F.when(~is_last | F.col("ends_in_lf"), strip_cr(F.col("text")))
            .otherwise(F.col("text"))
            .alias("text"),
            is_last.alias("is_last"),
            (F.col("lines_before") + 1).alias("block_first"),
            (F.col("lines_before") + F.col("n")).alias("block_last"),
        )
    )


def strip_cr(text: Column) -> Column:
    return F.when(text.endswith("\r"), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def carry_forward(df: DataFrame, opener: Column, name: str, order: str = "record", by: str = "source") -> DataFrame:
    """Give each row the last non-NULL ``opener`` at or before it within ``by``.

    Works in two levels so that no task holds a whole file: rows are ranged into runs of consecutive
    order values, each run carries inside itself, and runs without an opener of their own take it from
    a table with one row per run.
    """
    run_length = 1_000_000
    runs = df.withColumn("_run", F.floor(F.col(order) / run_length)).withColumn("_open", opener)
    inside = Window.partitionBy(by, "_run").orderBy(order)
    closing = runs.groupBy(by, "_run").agg(F.max_by("_open", F.when(F.col("_open").isNotNull(), F.col(order))).alias("_at_end"))
    prior = Window.partitionBy(by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    entering = closing.select(by, "_run", F.last("_at_end", ignorenulls=True).over(prior).alias("_entering"))
    return (
        runs.withColumn("_here", F.last("_open", ignorenulls=True).over(inside))
        .join(entering, [by, "_run"], "left")
        .withColumn(name, F.coalesce("_here", "_entering"))
        .drop("_run", "_open", "_here", "_entering")
    )
