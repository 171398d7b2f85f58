"""Per-run count files in three formats, and wide matrices."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.functions.text import COUNT_TYPE, plain_path, uint64_value
from exprspark.session import Workspace
from exprspark.sources.tsv import TableFormatError, empty_files, read_table, rejects, scan_tsv

# Header cells of the accepted count formats.
NATIVE_HEADER = ["gene_id", "count"]
TABLE_PREFIX = ["Geneid", "Chr", "Start", "End", "Strand", "Length"]
FORMATS = ("tsv", "legacy", "featurecounts")
ASSIGNED = "Assigned"

PROBLEM_COLUMNS = ["source", "record", "column", "rule", "rule_order"]


class CountScan(NamedTuple):
    counts: DataFrame  # run_id, source, record, gene_id, count
    problems: DataFrame  # source, record, column, rule, rule_order


def _problem(df: DataFrame, when: Column, column: Column | str, rule: str, order: int) -> DataFrame:
    name = F.lit(column) if isinstance(column, str) else column.cast("string")
    return df.filter(when).select(
        "source", "record", name.alias("column"), F.lit(rule).alias("rule"), F.lit(order).alias("rule_order")
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def with_run(scan: DataFrame, inputs: DataFrame) -> DataFrame:
    """Attach run id and count column through the file path; the manifest has one row per file."""
    return scan.withColumn("path", plain_path(F.col("source"))).join(F.broadcast(inputs), "path")


def _counts_of(rows: DataFrame, gene: Column, text: Column, name: Column) -> CountScan:
    picked = rows.select(
        "run_id", "source", "record", gene.alias("gene_id"), text.alias("text"), name.alias("column")
    ).withColumn("count", uint64_value(F.col("text")))
    bad = _problem(picked, F.col("count").isNull(), F.col("column"), "count_value", 20)
    return CountScan(picked.drop("text", "column"), bad)


def native_counts(scan: DataFrame) -> CountScan:
    expected = F.array(*[F.lit(h) for h in NATIVE_HEADER])
    head = _problem(
        scan, F.col("is_head") & F.col("cells").isNotNull() & (F.col("cells") != expected), "1", "header", 10
    )
    rows = scan.filter(~F.col("is_head") & F.col("cells").isNotNull() & (F.size("cells") == 2))
    counts, bad = _counts_of(rows, F.col("cells")[0], F.col("cells")[1], F.lit("count"))
    return CountScan(counts, head.unionByName(bad))


def legacy_counts(scan: DataFrame) -> CountScan:
    sound = scan.filter(F.col("cells").isNotNull())
    width = _problem(sound, F.size("cells") != 2, F.size("cells"), "width", 10)
    rows = sound.filter(F.size("cells") == 2)
    counts, bad = _counts_of(rows, F.col("cells")[0], F.col("cells")[1], F.lit("count"))
    return CountScan(counts, width.unionByName(bad))


def _header_problems(heads: DataFrame) -> DataFrame:
    repeated = (F.size(F.array_distinct("cells")) < F.size("cells")) | F.array_contains("cells", "")
    return _problem(heads, repeated, "1", "repeated_header", 11)


def table_counts(scan: DataFrame) -> CountScan:
    """Six annotation columns, then count columns: one is picked by name, all must hold counts."""
    first_count = len(TABLE_PREFIX) + 1
    heads = scan.filter(F.col("is_head") & F.col("cells").isNotNull())
    prefix = F.array(*[F.lit(h) for h in TABLE_PREFIX])
    position = F.array_position("cells", F.col("column"))
    wrong_prefix = (F.slice("cells", 1, len(TABLE_PREFIX)) != prefix) | (F.size("cells") < first_count)
    problems = [
        _problem(heads, wrong_prefix, "1", "header", 10),
        _header_problems(heads),
        _problem(heads, position == 0, F.col("column"), "column_missing", 12),
        _problem(heads, (position > 0) & (position < first_count), F.col("column"), "column_not_a_count", 13),
    ]
    picks = heads.select("run_id", position.cast("int").alias("pick")).filter(F.col("pick") >= first_count)
    rows = scan.filter(~F.col("is_head") & F.col("cells").isNotNull()).join(F.broadcast(picks), "run_id")
    others = F.slice("cells", F.lit(first_count), F.greatest(F.size("cells") - first_count + 1, F.lit(0)))
    bad_flags = F.transform(others, lambda c: uint64_value(c).isNull())
    problems.append(
        _problem(
            rows,
            F.array_contains(bad_flags, True),
            F.array_position(bad_flags, True) + first_count - 1,
            "count_value",
            20,
        )
    )
    counts, _ = _counts_of(rows, F.col("cells")[0], F.element_at("cells", F.col("pick")), F.col("column"))
    return CountScan(counts, _union(problems))


READERS = {"tsv": native_counts, "legacy": legacy_counts, "featurecounts": table_counts}


def read_run_counts(spark: SparkSession, inputs: DataFrame) -> CountScan:
    """Long counts of all files a manifest names: ``inputs(run_id, format, path, column)``.

    Files of one format are read in one scan, which is written once: counts and all checks read it. Only the path list reaches the driver, which lists those
    files for the scan anyway.
    """
    ws = Workspace(spark, "counts")
    listed: dict[str, set[str]] = {}
    for row in inputs.select("format", "path").distinct().collect():
        listed.setdefault(row["format"], set()).add(row["path"])
    counts, problems = [], []
    for fmt in FORMATS:
        if fmt not in listed:
            continue
        mine = inputs.filter(F.col("format") == fmt)
        scan = ws.save(scan_tsv(spark, sorted(listed[fmt]), leading_comments=fmt == "featurecounts"), fmt)
        got = READERS[fmt](with_run(scan, mine))
        counts.append(got.counts)
        paths = mine.select(F.col("path").alias("source")).distinct()
        seen = scan.select(plain_path(F.col("source")).alias("source"))
        problems += [rejects(scan), got.problems, empty_files(seen, paths)]
        if fmt == "featurecounts":
            summary = read_summaries(spark, mine)
            problems.append(summary.problems)
    return CountScan(_union(counts), _union(problems))


def read_summaries(spark: SparkSession, inputs: DataFrame) -> CountScan:
    """Assignment summaries beside the count tables as ``(run_id, status, count)``, every column kept."""
    beside = inputs.withColumn("path", F.concat("path", F.lit(".summary")))
    paths = sorted({r["path"] for r in beside.select("path").distinct().collect()})
    listed = scan_tsv(spark, paths)
    scan = with_run(listed, beside)
    heads = scan.filter(F.col("is_head") & F.col("cells").isNotNull())
    position = F.array_position("cells", F.col("column"))
    rows = scan.filter(~F.col("is_head") & F.col("cells").isNotNull())
    status = F.col("cells")[0]
    values = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))
    bad_flags = F.transform(values, lambda c: uint64_value(c).isNull())
    first_seen = rows.groupBy("run_id", status.alias("status")).agg(F.min("record").alias("first_record"))
    keyed = rows.withColumn("status", status)
    repeats = keyed.join(first_seen, ["run_id", "status"])
    has_assigned = rows.filter(status == ASSIGNED).select("run_id").distinct()
    problems = [
        rejects(listed),
        _problem(heads, (F.col("cells")[0] != "Status") | (F.size("cells") < 2), "Status", "header", 10),
        _header_problems(heads),
        _problem(heads, position <= 1, F.col("column"), "column_missing", 12),
        _problem(
            repeats,
            (F.col("record") > F.col("first_record")) | (F.col("status") == ""),
            "Status",
            "repeated_status",
            14,
        ),
        _problem(
            rows, F.array_contains(bad_flags, True), F.array_position(bad_flags, True) + 1, "count_value", 20
        ),
        _problem(
            heads.join(has_assigned, "run_id", "left_anti"), F.lit(True), "Status", "assigned_missing", 30
        ),
        empty_files(listed.select(plain_path(F.col("source")).alias("source")), beside.select(F.col("path").alias("source"))),
    ]
    names = heads.select("run_id", F.slice("cells", F.lit(2), F.size("cells") - 1).alias("columns"))
    long = (
        keyed.drop("column").join(names, "run_id")
        .select("run_id", "source", "record", "status", F.explode(F.arrays_zip("columns", values.alias("v"))).alias("c"))
        .select("run_id", "source", "record", "status", F.col("c.columns").alias("column"), uint64_value(F.col("c.v")).alias("count"))
    )
    return CountScan(long, _union(problems))


def sole_count_column(scan: DataFrame) -> DataFrame:
    """The one count column of each table file as ``(source, column)``; NULL when there is not exactly one."""
    only = F.when(F.size("cells") == len(TABLE_PREFIX) + 1, F.element_at("cells", len(TABLE_PREFIX) + 1))
    return scan.filter("is_head").select("source", only.alias("column"))


def wide_to_long(wide: DataFrame, sample_ids: list[str], gene: str = "gene_id") -> DataFrame:
    """A gene x sample table as ``(gene_id, sample_id, count)``; cells stay as they were typed."""
    columns = [F.col(f"`{s}`") for s in sample_ids]
    return wide.unpivot(F.col(gene).alias("gene_id"), columns, "sample_id", "count")


def read_matrix(spark: SparkSession, path: str, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """A wide table as packed rows, ``keys`` and the array ``x``, with the names of its value columns in order.

    NA is NULL; another cell that is no number fails the job that reads it.
    """
    wide = read_table(spark, path)
    columns = wide.columns[2:]
    if columns[: len(keys)] != keys:
        raise TableFormatError(f"{path}: expected {keys} first")
    names = columns[len(keys):]
    cells = F.array(*[F.col("`" + n.replace("`", "``") + "`") for n in names]).cast("array<string>")
    numbers = F.transform(cells, lambda c: F.nullif(c, F.lit("NA")).cast("double"))
    return wide.select(*[F.col(f"`{k}`") for k in keys], numbers.alias("x")), names


def typed_counts(long: DataFrame) -> DataFrame:
    """Parse text counts of a long matrix; a cell that is not a count becomes NULL."""
    return long.withColumn("count", uint64_value(F.col("count")).cast(COUNT_TYPE))
