"""Views that read the standard tables as count data, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.operators.counts import dense, merge_runs, to_wide
from exprspark.operators.ordering import adjust_p
from exprspark.plans.registry import table
from exprspark.session import Workspace
from exprspark.stats.normalize import normalized, size_factors

SAMPLES = [f"S{i}" for i in range(1, 8)]
FLAGS = ["A", "N", "R"]
ALPHA = 0.05

# Line items as technical-run counts: part = gene, line number = sample, line number and flag = run.
RUN_COUNTS_SQL = """
run_counts AS (
  SELECT 'P' || l_partkey AS gene_id, 'R' || l_linenumber || '_' || l_returnflag AS run_id,
         'S' || l_linenumber AS sample_id, l_returnflag AS flag,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS count
  FROM lineitem GROUP BY ALL
),
merged AS (
  SELECT gene_id, sample_id, CAST(SUM(count) AS BIGINT) AS count FROM run_counts GROUP BY ALL
),
samples AS (SELECT 'S' || i AS sample_id FROM range(1, 8) r(i)),
matrix AS (
  SELECT g.gene_id, s.sample_id, COALESCE(m.count, 0) AS count
  FROM (SELECT DISTINCT gene_id FROM merged) g CROSS JOIN samples s
  LEFT JOIN merged m ON m.gene_id = g.gene_id AND m.sample_id = s.sample_id
),
logged AS (
  SELECT gene_id, AVG(LN(count)) AS mean_log FROM matrix WHERE count > 0
  GROUP BY gene_id HAVING COUNT(*) = 7
),
factors AS (
  SELECT sample_id, EXP(MEDIAN(LN(count) - mean_log)) AS size_factor
  FROM matrix JOIN logged USING (gene_id) GROUP BY sample_id
),
normalized AS (
  SELECT gene_id, sample_id, count / size_factor AS value FROM matrix JOIN factors USING (sample_id)
)"""


def run_counts(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_partkey", "l_linenumber", "l_returnflag", "l_quantity")
    line = F.col("l_linenumber").cast("string")
    return (
        items.groupBy(
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("gene_id"),
            F.concat(F.lit("R"), line, F.lit("_"), F.col("l_returnflag")).alias("run_id"),
        )
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))
    )


def run_manifest(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_linenumber", "l_returnflag").distinct()
    line = F.col("l_linenumber").cast("string")
    return items.select(
        F.concat(F.lit("R"), line, F.lit("_"), F.col("l_returnflag")).alias("run_id"),
        F.concat(F.lit("S"), line).alias("sample_id"),
        F.col("l_returnflag").alias("flag"),
    )


def merged(spark: SparkSession, sf: str) -> DataFrame:
    return merge_runs(run_counts(spark, sf), run_manifest(spark, sf)).withColumn("count", F.col("count").cast("bigint"))


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    return dense(merged(spark, sf), SAMPLES)


def packed(spark: SparkSession, sf: str) -> DataFrame:
    """The matrix with one row per gene, written once: size factors and values both read it."""
    wide = to_wide(merged(spark, sf), SAMPLES)
    rows = wide.select("gene_id", F.array(*[F.col(s).cast("double") for s in SAMPLES]).alias("y"))
    return Workspace(spark, "view").save(rows, "packed")


def values(spark: SparkSession, sf: str) -> DataFrame:
    """Normalized counts in long form."""
    rows = packed(spark, sf)
    return normalized(rows, size_factors(rows, SAMPLES), SAMPLES)


def universe(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("gene_id"))


def annotation(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as gene annotation: names repeat like shared symbols, small parts have an empty chromosome."""
    return table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("gene_id"),
        F.col("p_name").alias("gene_symbol"),
        F.col("p_type").alias("biotype"),
        F.when(F.col("p_size") < 5, "").otherwise(F.col("p_brand")).alias("chromosome"),
    )


# A result table per backend: effect = log ratio of even to odd lines, p falls with the effect.
RESULTS_SQL = """
effects AS (
  SELECT 'P' || l_partkey AS gene_id, l_returnflag AS backend,
         SUM(CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS even,
         SUM(CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS odd
  FROM lineitem GROUP BY ALL
),
scored AS (
  SELECT gene_id, backend, CAST(even + odd AS DOUBLE) / 7 AS baseMean,
         LOG2((even + 1.0::DOUBLE) / (odd + 1.0::DOUBLE)) AS log2FoldChange,
         EXP(-6.0::DOUBLE * ABS(LOG2((even + 1.0::DOUBLE) / (odd + 1.0::DOUBLE)))) AS pvalue
  FROM effects
),
ranked AS (
  SELECT *, COUNT(*) OVER (PARTITION BY backend) * pvalue
            / COUNT(*) OVER (PARTITION BY backend ORDER BY pvalue RANGE UNBOUNDED PRECEDING) AS step
  FROM scored
),
results AS (
  SELECT gene_id, backend, baseMean, log2FoldChange, pvalue,
         LEAST(1.0, MIN(step) OVER (PARTITION BY backend ORDER BY pvalue DESC RANGE UNBOUNDED PRECEDING)) AS padj
  FROM ranked
)"""


def results(spark: SparkSession, sf: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    is_even = F.col("l_linenumber") % 2 == 0
    items = table(spark, sf, "lineitem").select("l_partkey", "l_linenumber", "l_returnflag", "l_quantity")
    effects = items.groupBy(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("gene_id"), F.col("l_returnflag").alias("backend")
    ).agg(
        F.sum(F.when(is_even, quantity).otherwise(0)).alias("even"), F.sum(F.when(is_even, 0).otherwise(quantity)).alias("odd")
    )
    lfc = F.log2((F.col("even") + 1.0) / (F.col("odd") + 1.0))
    scored = effects.select(
        "gene_id",
        "backend",
        ((F.col("even") + F.col("odd")).cast("double") / 7).alias("baseMean"),
        lfc.alias("log2FoldChange"),
        F.exp(-6.0 * F.abs(lfc)).alias("pvalue"),
    )
    return adjust_p(scored, "pvalue", ["backend"])
