"""Comparison of matrices, result tables, mappings and repeated runs."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.operators.ordering import exact_quantiles, top_per_group
from exprspark.session import Workspace
from exprspark.sources.records import refuse

# Parity tolerance.
ABS_TOL = 1e-10
REL_TOL = 1e-7


def is_finite(c: Column) -> Column:
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def close(actual: Column, expected: Column) -> Column:
    """Equal NULL masks, and numbers within the tolerance of the expected one."""
    near = F.abs(actual - expected) <= ABS_TOL + REL_TOL * F.abs(expected)
    return F.coalesce(near, actual.isNull() & expected.isNull())


def pearson(x: str, y: str) -> Column:
    """Pearson correlation; NULL for fewer than two points or a constant side."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)), F.when(both, F.col(y))
    varies = (F.min(xs) < F.max(xs)) & (F.min(ys) < F.max(ys))
    mx, my = F.var_pop(xs), F.var_pop(ys)
    return F.when(varies, F.try_divide(F.covar_pop(xs.cast("double"), ys.cast("double")), F.sqrt(mx * my)))


def join_cells(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Cells of two long matrices side by side as ``keys + (a, b)``; a cell on one side only has a NULL."""
    keys = keys or ["gene_id", "sample_id"]
    left = a.select(*keys, F.col("count").alias("a"))
    right = b.select(*keys, F.col("count").alias("b"))
    return left.join(right, keys, "full_outer")


def unmatched_cells(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("a").isNull() | F.col("b").isNull())


def pairs_of(table: DataFrame, names: list[str], keys: list[str], values: dict[str, Column], by: str = "backend") -> DataFrame:
    """Every two of the named tables side by side, as ``keys + (by_a, by_b)`` and each value as ``value_a, value_b``.

    The tables are parts of one, told apart by ``by``, with one row per key at most (of more, each value's largest counts).
    They meet in one grouping by key, a hash aggregate for numbers, however many pairs there are. A key that one side lacks has NULL for all its values
    there; a key is listed for every pair once any of the named tables has it. Rows under other names take no part.
    """
    own = [F.max(F.when(F.col(by) == n, v)).alias(f"_{i}_{c}") for i, n in enumerate(names) for c, v in values.items()]
    rows = table.filter(F.col(by).isin(names)).groupBy(*keys).agg(*own)

    def pair(i: int, j: int) -> Column:
        sides = [F.lit(names[i]).alias(f"{by}_a"), F.lit(names[j]).alias(f"{by}_b")]
        return F.struct(*sides, *[F.col(f"_{n}_{c}").alias(f"{c}_{side}") for c in values for n, side in ((i, "a"), (j, "b"))])

    return rows.select(*keys, F.inline(F.array(*[pair(i, j) for i, j in combinations(range(len(names)), 2)])))


def compare_counts(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals over joined cells, one row, or one per group."""
    diff = F.abs(F.col("a") - F.col("b"))
    return cells.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(F.col("a") != F.col("b")).alias("differing_cells"),
        F.sum(diff).cast("bigint").alias("total_absolute_difference"),
        F.sum("a").cast("bigint").alias("total_a"),
        F.sum("b").cast("bigint").alias("total_b"),
        pearson("a", "b").alias("pearson"),
    )


def gene_differences(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    return cells.groupBy(*(by or []), "gene_id").agg(F.sum(F.abs(F.col("a") - F.col("b"))).cast("bigint").alias("difference"))


def largest_differences(cells: DataFrame, k: int = 10, by: list[str] | None = None) -> DataFrame:
    """Top genes by summed difference; ties go to the larger gene id."""
    return top_per_group(gene_differences(cells, by), k, [F.desc("difference"), F.desc("gene_id")], by)


def join_results(a: DataFrame, b: DataFrame, column: str = "log2FoldChange") -> DataFrame:
    """Common genes with a finite value on both sides as ``(gene_id, a, b)``."""
    left = a.filter(is_finite(F.col(column))).select("gene_id", F.col(column).alias("a"))
    right = b.filter(is_finite(F.col(column))).select("gene_id", F.col(column).alias("b"))
    return left.join(right, "gene_id")


def significant_genes(results: DataFrame, alpha: float = 0.05) -> DataFrame:
    return results.filter(is_finite(F.col("padj")) & (F.col("padj") < alpha)).select("gene_id")


def paired_results(results: DataFrame, names: list[str], alpha: float = 0.05, by: str = "backend") -> DataFrame:
    """Effects of every two result tables as ``gene_id, by_a, by_b, a, b, in_a, in_b``; an effect that is not finite is NULL."""
    lfc = F.when(is_finite(F.col("log2FoldChange")), F.col("log2FoldChange"))
    chosen = is_finite(F.col("padj")) & (F.col("padj") < alpha)
    return pairs_of(results, names, ["gene_id"], {"lfc": lfc, "chosen": chosen}, by).select(
        "gene_id", f"{by}_a", f"{by}_b", F.col("lfc_a").alias("a"), F.col("lfc_b").alias("b"),
        F.coalesce("chosen_a", F.lit(False)).alias("in_a"), F.coalesce("chosen_b", F.lit(False)).alias("in_b"),
    )


def compare_pairs(genes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Common genes, fold-change correlation, median difference, sign changes and gene-set overlap of paired results.

    One row, or one per group; without rows there are no groups. The rows are written once and serve every figure.
    """
    by = by or []
    genes = Workspace(genes.sparkSession, "compare").save(genes, "genes")
    known = F.col("a").isNotNull() & F.col("b").isNotNull()
    opposite = ((F.col("a") > 0) != (F.col("b") > 0)) & (F.col("a") != 0) & (F.col("b") != 0)
    totals = genes.groupBy(*by).agg(
        F.count_if(known).alias("common_genes"),
        pearson("a", "b").alias("lfc_pearson"),
        F.count_if(known & opposite).alias("sign_disagreements"),
        *overlap_sizes(),
    )
    distances = genes.filter(known).select(*by, F.abs(F.col("a") - F.col("b")).alias("d"))
    median = exact_quantiles(distances, "d", [0.5], by).select(*by, F.col("quantile").alias("median_absolute_difference"))
    joined = totals.join(median, by, "left") if by else totals.withColumn("median_absolute_difference", median.scalar())
    return joined.withColumn("jaccard", jaccard())


def compare_results(a: DataFrame, b: DataFrame, alpha: float = 0.05) -> DataFrame:
    """The comparison of two result tables in one row, also where both are empty."""
    sides = a.withColumn("backend", F.lit("a")).unionByName(b.withColumn("backend", F.lit("b")))
    return compare_pairs(paired_results(sides, ["a", "b"], alpha))


def overlap_sizes() -> list[Column]:
    """Sizes of two sets and of what they share and hold together, from rows with ``in_a`` and ``in_b``."""
    a, b = F.col("in_a"), F.col("in_b")
    return [F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"), F.count_if(a & b).alias("n_both"), F.count_if(a | b).alias("n_either")]


def jaccard() -> Column:
    return F.try_divide(F.col("n_both").cast("double"), F.col("n_either").cast("double"))


def set_overlap(a: DataFrame, b: DataFrame, key: str = "gene_id") -> DataFrame:
    """Sizes of two sets, their intersection and union, and their Jaccard index; NULL for an empty union."""
    sides = (
        a.select(key, F.lit(1).alias("side")).unionByName(b.select(key, F.lit(2).alias("side")))
        .groupBy(key).agg(F.bit_or("side").alias("sides"))
    )
    sizes = sides.agg(
        F.count_if(F.col("sides") != 2).alias("n_a"),
        F.count_if(F.col("sides") != 1).alias("n_b"),
        F.count_if(F.col("sides") == 3).alias("n_both"),
        F.count(F.lit(1)).alias("n_either"),
    )
    return sizes.withColumn("jaccard", jaccard())


def overlap_of_pairs(genes: DataFrame, by: list[str]) -> DataFrame:
    """``set_overlap`` of every group of rows with ``in_a`` and ``in_b``."""
    return genes.groupBy(*by).agg(*overlap_sizes()).withColumn("jaccard", jaccard())


def parity(expected: DataFrame, actual: DataFrame, keys: list[str], log_columns: tuple[str, ...] = ()) -> DataFrame:
    """Mismatching cells of two tables as ``keys + (column, problem)``; none means parity.

    Both tables must have the same columns. Rows on one side only, different NULL masks, numbers outside
    the tolerance and other values that differ are reported. Columns in ``log_columns`` must also agree on
    being zero and, where positive, agree in logarithm.
    """
    if sorted(expected.columns) != sorted(actual.columns):
        raise ValueError(f"columns differ: {sorted(expected.columns)} and {sorted(actual.columns)}")
    numeric_types = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")
    values = [c for c in expected.columns if c not in keys]
    types = dict(expected.dtypes)
    numeric = [c for c in values if types[c].startswith(numeric_types)]
    text = [c for c in values if c not in numeric]
    left = expected.select(*keys, F.struct(*[F.col(f"`{c}`") for c in values]).alias("e"))
    right = actual.select(*keys, F.struct(*[F.col(f"`{c}`") for c in values]).alias("x"))
    joined = left.join(right, keys, "full_outer")
    tests = []
    for c in values:
        e, x = F.col(f"e.`{c}`"), F.col(f"x.`{c}`")
        if c in numeric:
            e, x = e.cast("double"), x.cast("double")
            wrong = F.when(e.isNull() != x.isNull(), "null_mask").when(~close(x, e), "number")
            if c in log_columns:
                logs = F.abs(F.ln(F.greatest(x, F.lit(5e-324))) - F.ln(F.greatest(e, F.lit(5e-324)))) > REL_TOL
                wrong = wrong.when((e == 0) != (x == 0), "zero_mask").when((e > 0) & logs, "log_number")
        else:
            wrong = F.when(e.isNull() != x.isNull(), "null_mask").when(~e.eqNullSafe(x), "value")
        tests.append(F.when(wrong.isNotNull(), F.struct(F.lit(c).alias("column"), wrong.alias("problem"))))
    one_sided = F.array(
        F.struct(
            F.lit("*").alias("column"),
            F.when(F.col("x").isNull(), "missing_row").otherwise("extra_row").alias("problem"),
        )
    )
    found = F.when(F.col("e").isNull() | F.col("x").isNull(), one_sided).otherwise(
        F.filter(F.array(*tests), lambda t: t.isNotNull())
    )
    return joined.select(*keys, F.inline(found))


def packed_cells(table: str, df: DataFrame, keys: list[str], bookkeeping: dict[str, list[str]]) -> DataFrame:
    """``table, row, cells``: a table's rows by their key, each with its cells in order of column name.

    A cell has ``column, number, text``: numbers of any width as doubles, all else as text. Rows that only keep books, by
    the values a key column has, are left out.
    """
    numeric_types = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")
    for column, values in bookkeeping.items():
        if column in df.columns:
            df = df.filter(~F.coalesce(F.col(f"`{column}`").cast("string").isin(values), F.lit(False)))

    def cell(name: str, kind: str) -> Column:
        value, none = F.col(f"`{name}`"), F.lit(None)
        text = F.to_json(value) if kind.startswith(("array", "struct", "map")) else value.cast("string")
        number = kind.startswith(numeric_types)
        return F.struct(
            F.lit(name).alias("column"), (value if number else none).cast("double").alias("number"), (none if number else text).cast("string").alias("text")
        )

    cells = [cell(n, k) for n, k in sorted(df.dtypes) if n not in keys]
    empty = F.array().cast("array<struct<column:string,number:double,text:string>>")
    row = F.to_json(F.struct(*[F.col(f"`{k}`").cast("string").alias(k) for k in keys]), {"ignoreNullFields": "false"})
    return df.select(F.lit(table).alias("table"), row.alias("row"), (F.array(*cells) if cells else empty).alias("cells"))


def run_parity(
    expected: dict[str, DataFrame], actual: dict[str, DataFrame], keys: dict[str, list[str]], bookkeeping: dict[str, list[str]] | None = None
) -> DataFrame:
    """Differences of two runs' tables as ``table, row, column, problem``; none means parity.

    All tables are compared by one join, whatever their columns: each row is packed into its key, as JSON, and its cells.
    Tables and columns on one side only are told from the schemas alone (``row`` is NULL then, ``column`` too for a
    table); of a table whose columns differ the common ones are compared. Then come rows on one side only (``column`` is
    ``*``), different NULL masks, numbers outside the tolerance and other values that differ, a column being a number or
    not on both sides included. ``bookkeeping`` names key columns and the values whose rows are no result. Keys must be
    unique within a table.
    """
    books = bookkeeping or {}
    spark = next(iter([*expected.values(), *actual.values()])).sparkSession
    told, left, right = [], [], []
    for name in sorted({*expected, *actual}):
        if name not in actual or name not in expected:
            told.append((name, None, None, "missing_table" if name not in actual else "extra_table"))
            continue
        e, x = expected[name], actual[name]
        told += [(name, None, c, "missing_column") for c in e.columns if c not in x.columns]
        told += [(name, None, c, "extra_column") for c in x.columns if c not in e.columns]
        common = [c for c in e.columns if c in x.columns]
        left.append(packed_cells(name, e.select(*[f"`{c}`" for c in common]), keys[name], books))
        right.append(packed_cells(name, x.select(*[f"`{c}`" for c in common]), keys[name], books))
    found = spark.createDataFrame(told, "table string, row string, column string, problem string")
    if not left:
        return found

    def whole(parts: list[DataFrame], side: str) -> DataFrame:
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.withColumnRenamed("cells", side)

    joined = whole(left, "e").join(whole(right, "x"), ["table", "row"], "full_outer")

    def problem(e: Column, x: Column) -> Column:
        nothing_e, nothing_x = e["number"].isNull() & e["text"].isNull(), x["number"].isNull() & x["text"].isNull()
        kinds = e["number"].isNull() != x["number"].isNull()
        off = ~F.coalesce(close(x["number"], e["number"]) | (e["number"] == x["number"]), F.lit(False)) & e["number"].isNotNull()
        return F.when(nothing_e != nothing_x, "null_mask").when(kinds, "kind").when(off, "number").when(~e["text"].eqNullSafe(x["text"]), "value")

    cells = F.zip_with("e", "x", lambda e, x: F.struct(e["column"].alias("column"), problem(e, x).alias("problem")))
    one_sided = F.array(F.struct(F.lit("*").alias("column"), F.when(F.col("x").isNull(), "missing_row").otherwise("extra_row").alias("problem")))
    both = F.col("e").isNotNull() & F.col("x").isNotNull()
    rows = joined.select("table", "row", F.inline(F.when(both, F.filter(cells, lambda c: c["problem"].isNotNull())).otherwise(one_sided)))
    return found.unionByName(rows)


def mapping_metrics(sam: DataFrame, inputs: DataFrame, keys: list[str]) -> DataFrame:
    """Mapped, unique, multi-mapped and spliced primary records per run, and the mapping rate.

    A record that ``sam_violations`` lists fails the job, as does a run with more mapped records than reads.
    """
    place = F.concat(F.col("source"), F.lit(" read "), F.col("read_id"))
    sound = sam.filter(F.col("primary") | F.col("problem").isNotNull()).withColumn("nh", refuse(F.col("problem"), place, F.col("nh")))
    primary = sound.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mapped"),
        F.count_if(F.col("nh") == 1).alias("unique"),
        F.count_if(F.col("nh") > 1).alias("multimapped"),
        F.count_if("spliced").alias("spliced"),
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("mapped", "unique", "multimapped", "spliced")}
    joined = inputs.select(*keys, "input_reads").join(primary, keys, "left").withColumns(zero)
    more = F.when(F.col("mapped") > F.col("input_reads"), F.lit("more mapped records than reads"))
    run = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    rate = F.try_divide(F.col("mapped").cast("double"), F.col("input_reads").cast("double"))
    return joined.withColumn("mapping_rate", refuse(more, run, rate))


def repeat_equality(files: DataFrame) -> DataFrame:
    """Per (backend, artifact): number of repeats and whether all contents agree; NULL for a single one."""
    return files.groupBy("backend", "artifact").agg(
        F.count_distinct("repeat").alias("repeats"),
        F.when(F.count_distinct("repeat") > 1, F.min("sha256") == F.max("sha256")).alias("identical"),
    )


def run_pair_violations(runs: DataFrame, backends: list[str], repeats: int) -> DataFrame:
    """Expected (backend, repeat) pairs that are missing, doubled, not asked for, or failed."""
    expected = runs.sparkSession.createDataFrame(
        [(b, r) for b in backends for r in range(1, repeats + 1)], "backend string, repeat int"
    )
    seen = runs.groupBy("backend", "repeat").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") != 0).alias("failed")
    )
    joined = expected.withColumn("wanted", F.lit(True)).join(seen, ["backend", "repeat"], "full_outer")
    rule = (
        F.when(F.col("n").isNull(), "missing")
        .when(F.col("wanted").isNull(), "unexpected")
        .when(F.col("n") > 1, "repeated")
        .when(F.col("failed") > 0, "failed")
    )
    return joined.withColumn("rule", rule).filter("rule is not null").select("backend", "repeat", "rule")


def assigned_totals(matrix: DataFrame, summary: DataFrame, key: str = "backend") -> DataFrame:
    """Merged total against the sum of assigned fragments per backend."""
    merged = matrix.groupBy(key).agg(F.sum("count").cast("bigint").alias("merged"))
    assigned = summary.groupBy(key).agg(F.sum("Assigned").cast("bigint").alias("assigned"))
    return merged.join(assigned, key, "full_outer").withColumn("agrees", F.col("merged").eqNullSafe(F.col("assigned")))


def bytes_per_run(files: DataFrame) -> DataFrame:
    """Bytes of each top-level folder of an inventory."""
    return files.groupBy(F.split_part("path", F.lit("/"), F.lit(1)).alias("run")).agg(F.sum("bytes").alias("bytes"))
