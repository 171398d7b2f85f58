"""Whole runs: their tables compared, their models checked, and the order of their rows proven."""

from __future__ import annotations

from pyspark.sql import functions as F

from exprspark.operators import compare
from exprspark.operators.ordering import global_positions
from exprspark.plans.matrix_queries import WITH_RESULTS, saved_results
from exprspark.plans.record_queries import EXONS_SQL, reads
from exprspark.plans.registry import query, table
from exprspark.stats import model_checks

# Faults are planted in three tables of the second run: effects and p-values by part size, a label, a summary line.
RUN_SQL = WITH_RESULTS + """,
n AS (SELECT r.*, p_size, '{"backend":"' || backend || '","gene_id":"' || gene_id || '"}' AS "row" FROM results r JOIN part ON gene_id = 'P' || p_partkey),
status AS (SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'results' AS "table", "row", 'log2FoldChange' AS "column", 'number' AS problem FROM n
  WHERE p_size = 7 AND ABS(log2FoldChange * (1 + 1e-6) - log2FoldChange) > 1e-10 + 1e-7 * ABS(log2FoldChange)
UNION ALL SELECT 'results', "row", 'pvalue', 'null_mask' FROM n WHERE p_size = 9
UNION ALL SELECT 'results', "row", '*', 'missing_row' FROM n WHERE p_size = 11
UNION ALL SELECT 'totals', '{"l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus || '"}', 'label', 'value' FROM status WHERE l_linestatus = 'F'
UNION ALL SELECT 'summary', '{"key":"genes"}', 'value', 'value'
UNION ALL SELECT 'totals', NULL, 'extra', 'extra_column'
UNION ALL SELECT 'only_here', NULL, NULL, 'missing_table'"""


@query("run_parity", RUN_SQL)
def run_parity(spark, sf):
    """Two runs of four tables, whose summaries differ in the number of workers as well, which is no result."""
    results = saved_results(spark, sf).select("backend", "gene_id", "log2FoldChange", "pvalue")
    sizes = table(spark, sf, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("gene_id"), "p_size")
    size, lfc = F.col("p_size"), F.col("log2FoldChange")
    other = results.join(sizes, "gene_id").filter(size != 11).select(
        "backend", "gene_id", F.when(size == 7, lfc * (1 + 1e-6)).otherwise(lfc).alias("log2FoldChange"), F.when(size != 9, F.col("pvalue")).alias("pvalue")
    )
    totals = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    label = F.concat("l_returnflag", "l_linestatus")
    changed = F.when(F.col("l_linestatus") == "F", F.lower(label)).otherwise(label)

    def summary(workers: str, more: int):
        genes = sizes.agg((F.count(F.lit(1)) + more).cast("string").alias("value")).select(F.lit("genes").alias("key"), "value")
        return genes.unionByName(spark.createDataFrame([("workers", workers), ("alpha", "0.05")], "key string, value string"))

    return compare.run_parity(
        {"results": results, "totals": totals.withColumn("label", label), "summary": summary("1", 0), "only_here": sizes},
        {"results": other, "totals": totals.withColumn("label", changed).withColumn("extra", F.lit(1)), "summary": summary("4", 1)},
        {"results": ["backend", "gene_id"], "totals": ["l_returnflag", "l_linestatus"], "summary": ["key"]},
        {"key": ["workers"]},
    )


# A study per nation, its suppliers as samples: confounded factors, one level only, level names that collide.
STUDY_SQL = """WITH RECURSIVE s AS (
  SELECT 'N' || s_nationkey AS study, 'c1' AS contrast_id, 'S' || s_suppkey AS sample_id, s_nationkey % 4 = 0 AS has_num, s_acctbal AS num,
    CASE WHEN s_nationkey % 5 = 0 THEN CASE s_suppkey % 3 WHEN 0 THEN 'x-1' WHEN 1 THEN 'x.1' ELSE 'x2' END ELSE 'a' || (s_suppkey % 3) END AS a,
    CASE s_nationkey % 3 WHEN 0 THEN 'b' || (s_suppkey % 3) WHEN 1 THEN 'b' || ((s_suppkey // 3) % 2) ELSE 'only' END AS b
  FROM supplier
)"""
MODEL_SQL = STUDY_SQL + """,
reach AS (
  SELECT DISTINCT study, a, a AS other FROM s
  UNION SELECT r.study, r.a, y.a FROM reach r JOIN s x ON x.study = r.study AND x.a = r.other JOIN s y ON y.study = x.study AND y.b = x.b
),
parts AS (SELECT study, COUNT(DISTINCT least_a) AS parts FROM (SELECT study, a, MIN(other) AS least_a FROM reach GROUP BY 1, 2) GROUP BY 1),
shape AS (
  SELECT study, contrast_id, COUNT(*) AS n, COUNT(DISTINCT a) AS la, COUNT(DISTINCT b) AS lb, BOOL_OR(has_num) AS has_num,
    COUNT(DISTINCT replace(a, '-', '.')) AS plain FROM s GROUP BY 1, 2
),
ranked AS (SELECT *, la + lb - 1 + has_num::INT AS k, la + lb - parts AS r0 FROM shape JOIN parts USING (study)),
full_rank AS (SELECT *, r0 + CASE WHEN has_num AND n > r0 THEN 1 ELSE 0 END AS rank FROM ranked)
SELECT study, contrast_id, 'few_levels' AS rule, 'b' AS subject FROM shape WHERE lb < 2
UNION ALL SELECT study, contrast_id, 'few_levels', 'a' FROM shape WHERE la < 2
UNION ALL SELECT study, contrast_id, 'colliding_levels', 'a' FROM shape WHERE plain < la
UNION ALL SELECT study, contrast_id, 'rank_deficient', '' FROM full_rank WHERE rank < k
UNION ALL SELECT study, contrast_id, 'no_residual_df', '' FROM full_rank WHERE n <= k
UNION ALL SELECT study, contrast_id, 'ambiguous_names', '' FROM (
  SELECT study, contrast_id, COUNT(*) AS n, COUNT(DISTINCT replace(a, '-', '.')) AS d FROM (
    SELECT DISTINCT study, contrast_id, a FROM s
    QUALIFY a <> CASE WHEN BOOL_OR(a = 'a0') OVER (PARTITION BY study) THEN 'a0' ELSE MIN(a) OVER (PARTITION BY study) END
  ) GROUP BY 1, 2) WHERE d < n
UNION ALL SELECT study, contrast_id, 'no_coefficient', 'a1' FROM s GROUP BY 1, 2 HAVING NOT BOOL_OR(a = 'a1')
  OR (NOT BOOL_OR(a = 'a0') AND MIN(a) = 'a1')"""


def studies(spark, sf):
    """Covariates, design terms and contrasts of the studies."""
    supplier = table(spark, sf, "supplier")
    nation, key = F.col("s_nationkey"), F.col("s_suppkey")
    third = (key % 3).cast("string")
    odd = F.when(key % 3 == 0, "x-1").when(key % 3 == 1, "x.1").otherwise("x2")
    b = F.when(nation % 3 == 0, F.concat(F.lit("b"), third)).when(
        nation % 3 == 1, F.concat(F.lit("b"), (F.floor(key / 3) % 2).cast("string"))).otherwise("only")
    wide = supplier.select(
        F.concat(F.lit("N"), nation.cast("string")).alias("study"), F.concat(F.lit("S"), key.cast("string")).alias("sample_id"),
        F.when(nation % 5 == 0, odd).otherwise(F.concat(F.lit("a"), third)).alias("a"), b.alias("b"),
        F.when(nation % 4 == 0, F.col("s_acctbal").cast("double").cast("string")).alias("num"),
    )
    values = wide.unpivot(["study", "sample_id"], ["a", "b", "num"], "term", "value").filter("value IS NOT NULL")
    kinds = spark.createDataFrame([(1, "a", "categorical", "a0"), (2, "b", "categorical", None), (3, "num", "numeric", None)],
                                  "term_no int, term string, kind string, reference string")
    used = values.select("study", "term").distinct()
    terms = used.join(kinds, "term").withColumn("contrast_id", F.lit("c1"))
    contrasts = wide.select("study").distinct().select("study", F.lit("c1").alias("contrast_id"), F.lit("a").alias("factor"), F.lit("a1").alias("numerator"))
    return values, terms, contrasts


@query("model_violations", MODEL_SQL)
def model_violations(spark, sf):
    return model_checks.model_violations(*studies(spark, sf))


@query(
    "model_matrix",
    STUDY_SQL
    + """, la AS (SELECT study, LIST(DISTINCT a) AS l, CASE WHEN list_contains(LIST(a), 'a0') THEN 'a0' ELSE MIN(a) END AS ref FROM s GROUP BY 1),
    lb AS (SELECT study, LIST(DISTINCT b) AS l, MIN(b) AS ref FROM s GROUP BY 1)
    SELECT study, contrast_id, sample_id, '(Intercept)' AS name, 1.0::DOUBLE AS value FROM s
    UNION ALL SELECT study, contrast_id, sample_id, 'a' || level, (a = level)::INT::DOUBLE FROM s JOIN (SELECT study, ref, UNNEST(l) AS level FROM la) USING (study) WHERE level <> ref
    UNION ALL SELECT study, contrast_id, sample_id, 'b' || level, (b = level)::INT::DOUBLE FROM s JOIN (SELECT study, ref, UNNEST(l) AS level FROM lb) USING (study) WHERE level <> ref
    UNION ALL SELECT study, contrast_id, sample_id, 'num', num::DOUBLE FROM s WHERE has_num""",
)
def model_matrix(spark, sf):
    values, terms, _ = studies(spark, sf)
    return model_checks.design_cells(values, model_checks.design_columns(values, terms)).drop("col_no")


@query("coordinate_positions", f"WITH {EXONS_SQL} SELECT chrom, pos, name AS read_id, ROW_NUMBER() OVER (ORDER BY chrom, pos, name) AS position FROM lines")
def coordinate_positions(spark, sf):
    """The place of every alignment in coordinate order."""
    return global_positions(reads(spark, sf).select("chrom", "pos", "read_id"), ["chrom", "pos", "read_id"])


@query(
    "gene_order",
    """SELECT gene_id, ROW_NUMBER() OVER (ORDER BY gene_id) AS position FROM (
         SELECT 'P' || p_partkey AS gene_id FROM part UNION ALL SELECT 'Ä' || c_custkey FROM customer UNION ALL SELECT '𝛼' || s_suppkey FROM supplier)""",
)
def gene_order(spark, sf):
    """The place of every name in byte order, in which a canonical table lists them; names reach beyond the basic plane."""
    names = [("part", "P", "p_partkey"), ("customer", "Ä", "c_custkey"), ("supplier", "𝛼", "s_suppkey")]
    parts = [table(spark, sf, t).select(F.concat(F.lit(sign), F.col(c).cast("string")).alias("gene_id")) for t, sign, c in names]
    return global_positions(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["gene_id"])
