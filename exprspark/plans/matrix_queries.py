"""Queries on the count matrix, normalization, results and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from exprspark.functions.text import neg_log10
from exprspark.operators import checks, cohort, compare
from exprspark.operators.counts import annotate, dense, drop_zero_total, gene_totals, to_wide
from exprspark.operators.ordering import adjust_p, ordered_counts
from exprspark.plans.analysis import factor_array
from exprspark.plans.registry import query, table
from exprspark.plans.views import (
    ALPHA,
    FLAGS,
    RESULTS_SQL,
    RUN_COUNTS_SQL,
    SAMPLES,
    annotation,
    matrix,
    merged,
    packed,
    results,
    run_counts,
    run_manifest,
    universe,
    values,
)
from exprspark.session import Workspace
from exprspark.sinks.tables import write_matrix
from exprspark.sources.counts import read_matrix
from exprspark.stats import results as res
from exprspark.stats.normalize import base_moments, size_factors, vst_parametric
from exprspark.stats.transform import distances_of, gram, normalized_arrays, sample_distances

WITH = "WITH " + RUN_COUNTS_SQL
WITH_RESULTS = "WITH " + RESULTS_SQL
TREND = (0.01, 2.0)
VST_SQL = (
    "LOG2((1 + 2.0 + 2 * 0.01 * value + 2 * SQRT(0.01 * value * (2.0 + 1 + 0.01 * value))) / (4 * 0.01))"
)


@query("merge_counts", WITH + " SELECT gene_id, sample_id, count FROM merged")
def merge_counts(spark, sf):
    return merged(spark, sf)


PIVOT_SQL = ", ".join(f"CAST(COALESCE(SUM(count) FILTER (sample_id = '{s}'), 0) AS BIGINT) AS {s}" for s in SAMPLES)


@query("matrix_wide", f"{WITH} SELECT gene_id, {PIVOT_SQL} FROM merged GROUP BY gene_id")
def matrix_wide(spark, sf):
    return to_wide(merged(spark, sf), SAMPLES)


@query("matrix_long", WITH + " SELECT gene_id, sample_id, count FROM matrix")
def matrix_long(spark, sf):
    return matrix(spark, sf)


@query("gene_totals", WITH + " SELECT gene_id, CAST(SUM(count) AS BIGINT) AS total FROM merged GROUP BY gene_id")
def gene_totals_query(spark, sf):
    return gene_totals(merged(spark, sf))


BULK_SQL = """
WITH bulk AS (
  SELECT 'P' || l_partkey AS gene_id, 'S' || l_linenumber AS sample_id,
         COUNT(*) FILTER (l_quantity >= 49 AND l_returnflag = 'R') AS count
  FROM lineitem GROUP BY ALL
)
SELECT gene_id, sample_id, count FROM bulk
WHERE gene_id IN (SELECT gene_id FROM bulk GROUP BY gene_id HAVING SUM(count) > 0)
"""


@query("zero_total_filter", BULK_SQL)
def zero_total_filter(spark, sf):
    bulk = (F.col("l_quantity") >= 49) & (F.col("l_returnflag") == "R")
    cells = table(spark, sf, "lineitem").groupBy(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("gene_id"),
        F.concat(F.lit("S"), F.col("l_linenumber").cast("string")).alias("sample_id"),
    ).agg(F.count_if(bulk).alias("count"))
    return drop_zero_total(cells)


@query("size_factors", WITH + " SELECT sample_id, ROUND(size_factor, 6) AS size_factor FROM factors")
def size_factors_query(spark, sf):
    return size_factors(packed(spark, sf), SAMPLES).withColumn("size_factor", F.round("size_factor", 6))


@query("normalized_counts", WITH + " SELECT gene_id, sample_id, ROUND(value, 4) AS value FROM normalized")
def normalized_counts(spark, sf):
    return values(spark, sf).withColumn("value", F.round("value", 4))


def packed_values(spark, sf):
    """Normalized counts, one array per gene in sample order."""
    rows = packed(spark, sf)
    return normalized_arrays(rows, factor_array(size_factors(rows, SAMPLES), SAMPLES))


def unfolded(rows, names):
    return rows.select("*", F.posexplode("x").alias("at", "value")).withColumn("sample_id", F.array(*map(F.lit, names))[F.col("at")])


@query("normalized_table_roundtrip", WITH + " SELECT gene_id, sample_id, ROUND(value, 4) AS value FROM normalized")
def normalized_table_roundtrip(spark, sf):
    """Normalized counts written as a wide table without a pivot, and read back through the strict dialect."""
    target = Workspace(spark, "published").folder("normalized")
    write_matrix(packed_values(spark, sf), ["gene_id"], "x", SAMPLES, target, ["gene_id"])
    rows, names = read_matrix(spark, target, ["gene_id"])
    return unfolded(rows, names).select("gene_id", "sample_id", F.round("value", 4).alias("value"))


@query(
    "base_mean_var",
    WITH + " SELECT gene_id, ROUND(AVG(value), 4) AS base_mean, ROUND(VAR_SAMP(value), 3) AS base_var FROM normalized GROUP BY gene_id",
)
def base_mean_var(spark, sf):
    moments = base_moments(values(spark, sf))
    return moments.select("gene_id", F.round("base_mean", 4).alias("base_mean"), F.round("base_var", 3).alias("base_var"))


@query(
    "annotate_left",
    WITH
    + """ SELECT t.gene_id, t.total, NULLIF(p_name, '') AS gene_symbol, NULLIF(p_type, '') AS biotype,
             CASE WHEN p_size < 5 THEN NULL ELSE p_brand END AS chromosome
          FROM (SELECT gene_id, CAST(SUM(count) AS BIGINT) AS total FROM merged GROUP BY gene_id) t
          LEFT JOIN part ON t.gene_id = 'P' || p_partkey""",
)
def annotate_left(spark, sf):
    return annotate(gene_totals(merged(spark, sf)), annotation(spark, sf))


@query("vst_fixed_trend", f"{WITH} SELECT gene_id, sample_id, ROUND({VST_SQL}, 5) AS value FROM normalized")
def vst_fixed_trend(spark, sf):
    return vst_values(spark, sf).withColumn("value", F.round("value", 5))


def vst_values(spark, sf):
    return values(spark, sf).withColumn("value", vst_parametric(F.col("value"), *TREND))


DISTANCE_SQL = f"""{WITH}, vst AS (SELECT gene_id, sample_id, {VST_SQL} AS value FROM normalized)
SELECT a.sample_id AS sample_a, b.sample_id AS sample_b, ROUND(SQRT(SUM((a.value - b.value) * (a.value - b.value))), 4) AS distance
FROM vst a JOIN vst b ON a.gene_id = b.gene_id AND a.sample_id <= b.sample_id GROUP BY ALL"""


@query("sample_distances", DISTANCE_SQL)
def sample_distances_query(spark, sf):
    """All ordered pairs of samples, added up in narrow tiles; the half that the SQL lists."""
    samples = spark.createDataFrame(list(enumerate(SAMPLES)), "at int, sample_id string")
    found = sample_distances(vst_packed(spark, sf), samples).filter("sample_a <= sample_b")
    return found.withColumn("distance", F.round("distance", 4))


def vst_packed(spark, sf):
    rows = packed(spark, sf)
    factors = factor_array(size_factors(rows, SAMPLES), SAMPLES)
    return normalized_arrays(rows, factors).select(F.transform("x", lambda q: vst_parametric(q, *TREND)).alias("x"))


@query("sample_distances_packed", DISTANCE_SQL)
def sample_distances_packed(spark, sf):
    """The same distances without the driver: Gram rows joined with their own diagonal."""
    arrays = vst_packed(spark, sf)
    names = F.array(*[F.lit(s) for s in SAMPLES])
    return distances_of(gram(arrays)).select(
        names[F.col("i")].alias("sample_a"), names[F.col("j")].alias("sample_b"), F.round("distance", 4).alias("distance")
    )


@query(
    "bh_adjust",
    """WITH tests AS (SELECT event_id, event_type, LEAST(1.0, value / 500) AS p FROM events),
    ranked AS (SELECT *, COUNT(*) OVER (PARTITION BY event_type) * p
                 / COUNT(*) OVER (PARTITION BY event_type ORDER BY p RANGE UNBOUNDED PRECEDING) AS step FROM tests)
    SELECT event_id, event_type, ROUND(LEAST(1.0, MIN(step) OVER (PARTITION BY event_type ORDER BY p DESC RANGE UNBOUNDED PRECEDING)), 9) AS padj
    FROM ranked""",
)
def bh_adjust(spark, sf):
    p = F.least(F.lit(1.0), F.col("value") / 500)
    tests = table(spark, sf, "events").select("event_id", "event_type", p.alias("p"))
    return adjust_p(tests, "p", ["event_type"]).select("event_id", "event_type", F.round("padj", 9).alias("padj"))


@query(
    "volcano_data",
    WITH_RESULTS
    + """ SELECT gene_id, backend, ROUND(log2FoldChange, 6) AS log2FoldChange, ROUND(padj, 9) AS padj,
             ROUND(-LOG10(GREATEST(padj, 2.2250738585072014e-308)), 6) AS neg_log10_padj,
             COALESCE(padj < 0.05, FALSE) AS significant FROM results""",
)
def volcano_data(spark, sf):
    return results(spark, sf).select(
        "gene_id",
        "backend",
        F.round("log2FoldChange", 6).alias("log2FoldChange"),
        F.round("padj", 9).alias("padj"),
        F.round(neg_log10(F.col("padj")), 6).alias("neg_log10_padj"),
        res.is_significant(ALPHA).alias("significant"),
    )


@query(
    "ma_data",
    WITH_RESULTS
    + """ SELECT backend, gene_id, ROUND(baseMean, 6) AS baseMean, ROUND(log2FoldChange, 6) AS log2FoldChange,
             padj < 0.05 AS significant FROM results""",
)
def ma_data(spark, sf):
    table_ = res.ma_data(results(spark, sf), ALPHA, ["backend"])
    return table_.withColumns({c: F.round(c, 6) for c in ("baseMean", "log2FoldChange")})


@query(
    "heatmap_top50",
    "WITH "
    + RUN_COUNTS_SQL
    + ","
    + RESULTS_SQL
    + f""", top AS (SELECT backend, gene_id, ROW_NUMBER() OVER (PARTITION BY backend ORDER BY padj, gene_id) AS rank
             FROM results WHERE padj < 0.05 QUALIFY rank <= 50)
    SELECT backend, gene_id, sample_id, ROUND({VST_SQL}, 5) AS value, CAST(rank AS INTEGER) AS rank FROM normalized JOIN top USING (gene_id)""",
)
def heatmap_top50(spark, sf):
    picked = res.heatmap(results(spark, sf), vst_values(spark, sf), ALPHA, ["backend"])
    return picked.select("backend", "gene_id", "sample_id", F.round("value", 5).alias("value"), "rank")


@query(
    "heatmap_table_roundtrip",
    "WITH "
    + RUN_COUNTS_SQL
    + ","
    + RESULTS_SQL
    + f""", top AS (SELECT backend, gene_id, ROW_NUMBER() OVER (PARTITION BY backend ORDER BY padj, gene_id) AS rank
             FROM results WHERE padj < 0.05 QUALIFY rank <= 50)
    SELECT backend, gene_id, sample_id, ROUND({VST_SQL}, 5) AS value FROM normalized JOIN top USING (gene_id)""",
)
def heatmap_table_roundtrip(spark, sf):
    """Every backend's top genes as rows of one wide table by backend and rank, read back; without genes the header is read back."""
    stable = packed_values(spark, sf).withColumn("x", F.transform("x", lambda q: vst_parametric(q, *TREND)))
    target = Workspace(spark, "published").folder("heatmap")
    write_matrix(res.heatmap(results(spark, sf), stable, ALPHA, ["backend"]), ["backend", "gene_id"], "x", SAMPLES, target, ["backend", "rank"])
    rows, names = read_matrix(spark, target, ["backend", "gene_id"])
    return unfolded(rows, names).select("backend", "gene_id", "sample_id", F.round("value", 5).alias("value"))


@query(
    "heatmap_by_contrast",
    WITH_RESULTS
    + """ SELECT backend, gene_id, CAST(rank AS INTEGER) AS rank FROM (
            SELECT backend, gene_id, ROW_NUMBER() OVER (PARTITION BY backend ORDER BY padj, gene_id) AS rank
            FROM results WHERE padj < 0.05) WHERE rank <= 50""",
)
def heatmap_by_contrast(spark, sf):
    return res.top_significant(results(spark, sf), ALPHA, 50, ["backend"]).select("backend", "gene_id", "rank")


@query(
    "de_summary",
    WITH_RESULTS
    + """ SELECT backend, COUNT(*) AS genes, COUNT(*) FILTER (padj < 0.05 AND log2FoldChange > 0) AS up,
             COUNT(*) FILTER (padj < 0.05 AND log2FoldChange < 0) AS down,
             COUNT(*) FILTER (padj < 0.05 AND ABS(log2FoldChange) > 2) AS strong,
             ROUND(100.0 * COUNT(*) FILTER (padj < 0.05 AND log2FoldChange > 0) / COUNT(*), 6) AS up_percent,
             ROUND(100.0 * COUNT(*) FILTER (padj < 0.05 AND log2FoldChange < 0) / COUNT(*), 6) AS down_percent
          FROM results GROUP BY backend""",
)
def de_summary(spark, sf):
    table_ = res.summary(results(spark, sf), ["backend"], ALPHA)
    return table_.select(
        "backend", "genes", "up", "down", "strong",
        F.round("up_percent", 6).alias("up_percent"), F.round("down_percent", 6).alias("down_percent"),
    )


@query(
    "contrast_summary",
    WITH_RESULTS
    + """, r AS (SELECT backend, COUNT(*) AS n, COUNT(*) FILTER (padj < 0.05) AS hits, COUNT(*) FILTER (padj IS NULL) AS unknown
                 FROM results GROUP BY backend)
    SELECT backend, UNNEST(['contrast_id', 'alpha', 'genes_retained', 'significant', 'padj_na']) AS key,
           UNNEST(['even_vs_odd', '0.05', CAST(n AS VARCHAR), CAST(hits AS VARCHAR), CAST(unknown AS VARCHAR)]) AS value FROM r""",
)
def contrast_summary(spark, sf):
    facts = {"contrast_id": "even_vs_odd", "alpha": "0.05"}
    return res.contrast_summary(results(spark, sf), facts, ALPHA, ["backend"])


PAIR = ["backend_a", "backend_b"]
PAIRS_SQL = """,
pairs AS (SELECT a.f AS backend_a, b.f AS backend_b
          FROM (SELECT DISTINCT l_returnflag AS f FROM lineitem) a JOIN (SELECT DISTINCT l_returnflag AS f FROM lineitem) b ON a.f < b.f)"""
CELLS_SQL = WITH + PAIRS_SQL + """,
by_flag AS (SELECT flag, gene_id, sample_id, CAST(SUM(count) AS BIGINT) AS count FROM run_counts GROUP BY ALL),
grid AS (SELECT DISTINCT backend_a, backend_b, 'P' || p_partkey AS gene_id, sample_id FROM part CROSS JOIN samples CROSS JOIN pairs),
cells AS (SELECT backend_a, backend_b, g.gene_id, g.sample_id, COALESCE(x.count, 0) AS a, COALESCE(y.count, 0) AS b FROM grid g
  LEFT JOIN by_flag x ON x.flag = backend_a AND x.gene_id = g.gene_id AND x.sample_id = g.sample_id
  LEFT JOIN by_flag y ON y.flag = backend_b AND y.gene_id = g.gene_id AND y.sample_id = g.sample_id)"""


def flag_cells(spark, sf):
    """Cells of every two flags side by side; a part nobody ordered counts zero. Grid and pairs are made gene by gene."""
    sums = run_counts(spark, sf).join(run_manifest(spark, sf), "run_id")
    cell = F.concat_ws(":", "flag", "sample_id").alias("sample_id")
    grid = dense(sums.select("gene_id", cell, "count"), [f"{f}:{s}" for f in FLAGS for s in SAMPLES], universe(spark, sf))
    place = F.split("sample_id", ":")
    cells = grid.select("gene_id", place[0].alias("backend"), place[1].alias("sample_id"), "count")
    pairs = compare.pairs_of(cells, FLAGS, ["gene_id", "sample_id"], {"count": F.col("count")})
    return pairs.select(*PAIR, "gene_id", "sample_id", F.col("count_a").alias("a"), F.col("count_b").alias("b"))


@query(
    "compare_counts",
    CELLS_SQL
    + """ SELECT backend_a, backend_b, COUNT(*) AS cells, COUNT(*) FILTER (a <> b) AS differing_cells,
             CAST(SUM(ABS(a - b)) AS BIGINT) AS total_absolute_difference, CAST(SUM(a) AS BIGINT) AS total_a,
             CAST(SUM(b) AS BIGINT) AS total_b, ROUND(CORR(a, b), 8) AS pearson FROM cells GROUP BY ALL""",
)
def compare_counts(spark, sf):
    return compare.compare_counts(flag_cells(spark, sf), PAIR).withColumn("pearson", F.round("pearson", 8))


@query(
    "gene_differences",
    CELLS_SQL + " SELECT backend_a, backend_b, gene_id, CAST(SUM(ABS(a - b)) AS BIGINT) AS difference FROM cells GROUP BY ALL",
)
def gene_differences(spark, sf):
    return compare.gene_differences(flag_cells(spark, sf), PAIR)


@query(
    "top_gene_diff",
    CELLS_SQL
    + """ SELECT backend_a, backend_b, gene_id, difference,
                 CAST(ROW_NUMBER() OVER (PARTITION BY backend_a, backend_b ORDER BY difference DESC, gene_id DESC) AS INTEGER) AS rank
          FROM (SELECT backend_a, backend_b, gene_id, CAST(SUM(ABS(a - b)) AS BIGINT) AS difference FROM cells GROUP BY ALL)
          QUALIFY rank <= 10""",
)
def top_gene_diff(spark, sf):
    return compare.largest_differences(flag_cells(spark, sf), by=PAIR)


PAIR_SQL = WITH_RESULTS + PAIRS_SQL + """,
sets AS (SELECT backend_a, backend_b, gene_id, BOOL_OR(backend = backend_a) AS in_a, BOOL_OR(backend = backend_b) AS in_b
         FROM pairs JOIN results ON padj < 0.05 AND (backend = backend_a OR backend = backend_b) GROUP BY ALL),
overlap AS (SELECT backend_a, backend_b, n_a, n_b, n_both, n_either, ROUND(n_both::DOUBLE / NULLIF(n_either, 0), 8) AS jaccard FROM (
  SELECT p.backend_a, p.backend_b, COUNT(*) FILTER (in_a) AS n_a, COUNT(*) FILTER (in_b) AS n_b, COUNT(*) FILTER (in_a AND in_b) AS n_both,
         COUNT(gene_id) AS n_either FROM pairs p LEFT JOIN sets s ON s.backend_a = p.backend_a AND s.backend_b = p.backend_b GROUP BY ALL)),
effect AS (SELECT p.*, x.log2FoldChange AS a, y.log2FoldChange AS b
           FROM pairs p JOIN results x ON x.backend = backend_a JOIN results y ON y.backend = backend_b AND y.gene_id = x.gene_id)"""


def result_pairs(spark, sf):
    """Results of every two flags side by side, in one grouping by gene."""
    return compare.paired_results(results(spark, sf), FLAGS, ALPHA)


@query(
    "compare_results",
    PAIR_SQL
    + """ SELECT * FROM overlap JOIN (
             SELECT backend_a, backend_b, COUNT(*) AS common_genes, ROUND(CORR(a, b), 8) AS lfc_pearson,
                    COUNT(*) FILTER ((a > 0) <> (b > 0) AND a <> 0 AND b <> 0) AS sign_disagreements,
                    ROUND(MEDIAN(ABS(a - b)), 8) AS median_absolute_difference FROM effect GROUP BY ALL) USING (backend_a, backend_b)""",
)
def compare_results(spark, sf):
    report = compare.compare_pairs(result_pairs(spark, sf), PAIR)
    return report.withColumns({c: F.round(c, 8) for c in ("lfc_pearson", "median_absolute_difference", "jaccard")})


@query("deg_jaccard", PAIR_SQL + " SELECT * FROM overlap")
def deg_jaccard(spark, sf):
    return compare.overlap_of_pairs(result_pairs(spark, sf), PAIR).withColumn("jaccard", F.round("jaccard", 8))


@query("deg_union", PAIR_SQL + " SELECT backend_a, backend_b, gene_id FROM sets")
def deg_union(spark, sf):
    return result_pairs(spark, sf).filter("in_a OR in_b").select(*PAIR, "gene_id")


@query("deg_intersection", PAIR_SQL + " SELECT backend_a, backend_b, gene_id FROM sets WHERE in_a AND in_b")
def deg_intersection(spark, sf):
    return result_pairs(spark, sf).filter("in_a AND in_b").select(*PAIR, "gene_id")


@query(
    "deg_novel_absent",
    PAIR_SQL + " SELECT backend_a, backend_b, gene_id, CASE WHEN in_a THEN 'novel' ELSE 'absent' END AS state FROM sets WHERE in_a <> in_b",
)
def deg_novel_absent(spark, sf):
    state = F.when(F.col("in_a"), "novel").otherwise("absent").alias("state")
    return result_pairs(spark, sf).filter("in_a <> in_b").select(*PAIR, "gene_id", state)


@query(
    "gene_set_equality",
    """WITH k AS (SELECT DISTINCT l_returnflag AS f, l_partkey AS k FROM lineitem)""" + PAIRS_SQL + """
       SELECT *, only_left + only_right = 0 AS equal FROM (
         SELECT backend_a, backend_b,
           (SELECT COUNT(*) FROM k x WHERE x.f = backend_a AND x.k NOT IN (SELECT y.k FROM k y WHERE y.f = backend_b)) AS only_left,
           (SELECT COUNT(*) FROM k x WHERE x.f = backend_b AND x.k NOT IN (SELECT y.k FROM k y WHERE y.f = backend_a)) AS only_right
         FROM pairs)""",
)
def gene_set_equality(spark, sf):
    items = table(spark, sf, "lineitem").select("l_partkey", F.col("l_returnflag").alias("backend"))
    return cohort.same_sets(items, FLAGS, ["l_partkey"])


def saved_results(spark, sf):
    """The result table, written once for a query that reads it more than once."""
    return Workspace(spark, "results").save(results(spark, sf), "results")


# The second table plants errors: effects off by 1e-6 relative, dropped padj, and lost rows, by part size.
PARITY_SQL = WITH_RESULTS + """,
n AS (SELECT r.*, p_size FROM results r JOIN part ON gene_id = 'P' || p_partkey),
joined AS (SELECT backend, gene_id, log2FoldChange AS e_lfc, pvalue AS e_p,
   CASE WHEN p_size = 7 THEN log2FoldChange * (1 + 1e-6) WHEN p_size = 8 THEN log2FoldChange * (1 + 1e-9) ELSE log2FoldChange END AS x_lfc,
   CASE WHEN p_size = 9 THEN NULL WHEN p_size = 10 THEN pvalue * (1 + 1e-6) ELSE pvalue END AS x_p, p_size FROM n)
SELECT backend, gene_id, 'log2FoldChange' AS "column", 'number' AS problem FROM joined
  WHERE p_size <> 11 AND ABS(x_lfc - e_lfc) > 1e-10 + 1e-7 * ABS(e_lfc)
UNION ALL SELECT backend, gene_id, 'pvalue', 'null_mask' FROM joined WHERE p_size = 9
UNION ALL SELECT backend, gene_id, 'pvalue', CASE WHEN ABS(x_p - e_p) > 1e-10 + 1e-7 * ABS(e_p) THEN 'number' ELSE 'log_number' END
  FROM joined WHERE p_size = 10 AND e_p > 0
UNION ALL SELECT backend, gene_id, '*', 'missing_row' FROM joined WHERE p_size = 11"""


@query("parity_diff", PARITY_SQL)
def parity_diff(spark, sf):
    expected = saved_results(spark, sf).select("backend", "gene_id", "log2FoldChange", "pvalue")
    sizes = table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("gene_id"), "p_size"
    )
    size, lfc, p = F.col("p_size"), F.col("log2FoldChange"), F.col("pvalue")
    actual = expected.join(sizes, "gene_id").filter(size != 11).select(
        "backend",
        "gene_id",
        F.when(size == 7, lfc * (1 + 1e-6)).when(size == 8, lfc * (1 + 1e-9)).otherwise(lfc).alias("log2FoldChange"),
        F.when(size == 10, p * (1 + 1e-6)).when(size != 9, p).alias("pvalue"),
    )
    return compare.parity(expected, actual, ["backend", "gene_id"], ("pvalue",))


@query(
    "completeness",
    WITH
    + """, seen AS (SELECT run_id, COUNT(DISTINCT gene_id) AS genes_seen FROM run_counts GROUP BY run_id)
    SELECT run_id, genes_seen, CAST(0 AS BIGINT) AS unknown_genes, CAST(0 AS BIGINT) AS repeated_genes,
           (SELECT COUNT(*) FROM part) - genes_seen AS missing_genes, (SELECT COUNT(*) FROM part) = genes_seen AS complete FROM seen""",
)
def completeness(spark, sf):
    return checks.completeness(run_counts(spark, sf), run_manifest(spark, sf), universe(spark, sf))


@query(
    "missing_genes",
    WITH
    + """ SELECT r.run_id, 'P' || p_partkey AS gene_id FROM (SELECT DISTINCT run_id FROM run_counts) r CROSS JOIN part
         EXCEPT SELECT run_id, gene_id FROM run_counts""",
)
def missing_genes(spark, sf):
    genes = universe(spark, sf)
    counts = Workspace(spark, "runs").save(run_counts(spark, sf), "counts")
    return checks.missing_genes(counts, checks.completeness(counts, run_manifest(spark, sf), genes), genes)


@query(
    "assigned_totals",
    """SELECT l_returnflag AS backend, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS merged,
              CAST(SUM(CAST(l_quantity AS BIGINT)) FILTER (l_tax > 0) AS BIGINT) AS assigned,
              SUM(CAST(l_quantity AS BIGINT)) IS NOT DISTINCT FROM SUM(CAST(l_quantity AS BIGINT)) FILTER (l_tax > 0) AS agrees
       FROM lineitem GROUP BY 1""",
)
def assigned_totals(spark, sf):
    """Merged totals against summaries that leave out untaxed lines, so the check has something to find."""
    merged_ = run_counts(spark, sf).join(run_manifest(spark, sf), "run_id").withColumnRenamed("flag", "backend")
    quantity = F.col("l_quantity").cast("bigint")
    summary = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("backend"), "l_linenumber").agg(
        F.sum(F.when(F.col("l_tax") > 0, quantity)).alias("Assigned")
    )
    return compare.assigned_totals(merged_, summary)


@query(
    "systematic_sample",
    """SELECT event_type, event_id, rec_idx FROM (SELECT event_type, event_id,
         ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS rec_idx FROM events) WHERE rec_idx % 5 = 0""",
)
def systematic_sample_query(spark, sf):
    from exprspark.sources.records import systematic_sample

    return systematic_sample(event_records(spark, sf), 5)


@query(
    "prefix_sample",
    """SELECT event_type, event_id, rec_idx FROM (SELECT event_type, event_id,
         ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS rec_idx FROM events) WHERE rec_idx < 50""",
)
def prefix_sample(spark, sf):
    from exprspark.sources.records import fastq_prefix

    return fastq_prefix(event_records(spark, sf), 50)


@query(
    "rank_large_ids",
    """SELECT event_type, event_id + 9007199254740992 AS big_id,
         ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) AS place,
         COUNT(*) OVER (PARTITION BY event_type) AS total FROM events""",
)
def rank_large_ids(spark, sf):
    """Ids past 2^53, where neighbours would be one number as doubles, over ranges far smaller than the table."""
    ids = table(spark, sf, "events").select("event_type", (F.col("event_id").cast("bigint") + F.lit(2**53)).alias("big_id"))
    ranked = ordered_counts(ids, "big_id", ["event_type"], rows_per_range=1_000)
    return ranked.select("event_type", "big_id", F.col("upto").cast("bigint").alias("place"), F.col("total").cast("bigint").alias("total"))


def event_records(spark, sf):
    """Events as records of one file per event type, numbered in order."""
    ids = table(spark, sf, "events").select("event_type", "event_id")
    ranked = ordered_counts(ids, "event_id", ["event_type"])
    return ranked.select("event_type", F.col("event_id").cast("bigint").alias("event_id"), (F.col("upto") - 1).alias("rec_idx"))
