"""The strict tab-separated dialect: sound records on one side, reject rows on the other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.functions.text import BOM, cell_is_closed, unquote
from exprspark.session import Workspace
from exprspark.sources.lines import numbered_lines

# Rule names in the order they are tested on one record.
DIALECT_RULES = ("blank", "utf8", "bom", "comment", "control", "quoting", "ragged")


def dialect_problem(text: Column, leading_comment: Column | None = None) -> Column:
    """The first dialect rule a line breaks as ``struct<rule,column>``, NULL for a sound line.

    Splitting at every tab is always right: a tab inside quotes leaves two unclosed cells behind.
    """
    cells = F.split(text, "\t", -1)
    bad_control = F.transform(cells, lambda c: c.contains("\0") | c.contains("\r") | c.contains("\n"))
    bad_quotes = F.transform(cells, lambda c: ~cell_is_closed(c))

    def hit(rule: str, column: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), column.cast("int").alias("column"))

    first = F.lit(1)
    comment = F.lit(False) if leading_comment is None else leading_comment
    return (
        F.when(text == "", hit("blank", first))
        .when(~F.is_valid_utf8(text), hit("utf8", first))
        .when(text.contains(BOM), hit("bom", first))
        .when(text.startswith("#") & ~comment, hit("comment", first))
        .when(F.array_contains(bad_control, True), hit("control", F.array_position(bad_control, True)))
        .when(comment, F.lit(None))
        .when(F.array_contains(bad_quotes, True), hit("quoting", F.array_position(bad_quotes, True)))
    )


def scan_tsv(spark: SparkSession, paths: str | list[str], leading_comments: bool = False) -> DataFrame:
    """All lines of the files as ``(source, record, cells, problem)``.

    ``problem`` names the first broken rule and its column, or is NULL. With ``leading_comments`` the
    ``#`` lines before the first data line are checked as text and then left out.
    """
    return check_lines(numbered_lines(spark, paths), leading_comments, files=True)


def check_lines(lines: DataFrame, leading_comments: bool = False, files: bool = False) -> DataFrame:
    """Dialect checks over numbered lines; the first data line of each source sets the width.

    Sources that are ``files`` are few beside their lines: their widths are broadcast, as a join by source would put a
    file's lines into one task.
    """
    is_data = ~F.col("text").startswith("#") if leading_comments else F.lit(True)
    width = F.size(F.split("text", "\t", -1))
    shape = (
        lines.withColumn("_data", is_data)
        .groupBy("source")
        .agg(
            F.min(F.when(F.col("_data"), F.struct("record", width.alias("width")))).alias("head"),
        )
        .select("source", F.col("head.record").alias("head_record"), F.col("head.width").alias("width"))
    )
    comment = F.col("text").startswith("#") & (
        F.col("head_record").isNull() | (F.col("record") < F.col("head_record"))
    )
    leading = comment if leading_comments else F.lit(False)
    found = dialect_problem(F.col("text"), leading)
    ragged = F.when(
        ~leading & (F.size(F.split("text", "\t", -1)) != F.col("width")),
        F.struct(F.lit("ragged").alias("rule"), F.size(F.split("text", "\t", -1)).alias("column")),
    )
    checked = lines.join(F.broadcast(shape) if files else shape, "source", "left").withColumn("problem", F.coalesce(found, ragged))
    cells = F.transform(F.split("text", "\t", -1), unquote)
    return checked.filter(~leading | F.col("problem").isNotNull()).select(
        "source",
        "record",
        F.when(F.col("problem").isNull(), cells).alias("cells"),
        (F.col("record") == F.col("head_record")).alias("is_head"),
        "problem",
    )


def rejects(scan: DataFrame) -> DataFrame:
    """Reject rows of a scan in the shape of a violation table."""
    order = reduce(
        lambda acc, item: acc.when(F.col("problem.rule") == item[1], F.lit(item[0])),
        list(enumerate(DIALECT_RULES))[1:],
        F.when(F.col("problem.rule") == DIALECT_RULES[0], F.lit(0)),
    )
    return scan.filter(F.col("problem").isNotNull()).select(
        "source",
        "record",
        F.col("problem.column").cast("string").alias("column"),
        F.concat(F.lit("dialect_"), F.col("problem.rule")).alias("rule"),
        order.alias("rule_order"),
    )


def empty_files(scan: DataFrame, sources: DataFrame) -> DataFrame:
    """Reject rows for listed sources that hold no line at all."""
    return sources.join(scan.select("source").distinct(), "source", "left_anti").select(
        "source",
        F.lit(1).cast("long").alias("record"),
        F.lit("1").alias("column"),
        F.lit("empty_file").alias("rule"),
        F.lit(-1).alias("rule_order"),
    )


class TableFormatError(ValueError):
    """A file that breaks the dialect or its declared columns."""


def bind_header(scan: DataFrame, schema: list[str] | None = None, name: str = "table") -> DataFrame:
    """Turn the scan of one file (or of parts sharing one header) into named string columns.

    The scan is written once, so the text is parsed a single time; only the header and at most one reject
    row reach the driver. ``schema`` demands exactly these columns in any order. The result keeps
    ``_source`` and ``_record``.
    """
    scan = Workspace(scan.sparkSession, "tsv").save(scan, "scan")
    head = F.when(F.col("is_head"), F.col("cells"))
    reject = F.when(F.col("problem").isNotNull(), F.struct("record", "source", F.col("problem.rule").alias("rule")))
    facts = scan.agg(F.min(reject).alias("bad"), F.min(head).alias("first"), F.max(head).alias("last")).first()
    if facts["bad"]:
        raise TableFormatError(f"{facts['bad']['source']}: record {facts['bad']['record']}: {facts['bad']['rule']}")
    if facts["first"] is None:
        raise TableFormatError(f"{name}: empty file")
    if facts["first"] != facts["last"]:
        raise TableFormatError(f"{name}: files with different headers")
    header = list(facts["first"])
    if len(set(header)) != len(header) or "" in header:
        raise TableFormatError(f"{name}: empty or repeated header cell")
    if schema is not None and set(header) != set(schema):
        raise TableFormatError(f"{name}: columns {header} are not {sorted(schema)}")
    columns = [F.col("cells")[i].alias(h) for i, h in enumerate(header)]
    return scan.filter(~F.col("is_head")).select(
        F.col("source").alias("_source"), F.col("record").alias("_record"), *columns
    )


def read_table(spark: SparkSession, path: str | list[str], schema: list[str] | None = None) -> DataFrame:
    return bind_header(scan_tsv(spark, path), schema, str(path))


def read_settings(spark: SparkSession, path: str) -> dict[str, str]:
    """A key/value table as a dictionary; keys must be unique and non-empty."""
    rows = read_table(spark, path, ["key", "value"]).select("key", "value").collect()
    settings = {r["key"]: r["value"] for r in rows}
    if len(settings) != len(rows) or "" in settings:
        raise TableFormatError(f"{path}: empty or repeated setting key")
    return settings
