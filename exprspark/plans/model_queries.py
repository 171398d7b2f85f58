"""Model fitting over the count view: dispersions, tests, shrinkage, PCA and the whole analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from exprspark.functions.text import coefficient_name
from exprspark.plans.analysis import factor_array, run_analysis
from exprspark.plans.registry import query, table
from exprspark.plans.views import SAMPLES, annotation, matrix, packed
from exprspark.session import Workspace
from exprspark.stats import results as res
from exprspark.stats import transform as tr
from exprspark.stats.design import build_model
from exprspark.stats.fit import fit_model
from exprspark.stats.normalize import size_factors


def condition(sample: str) -> str:
    return "treated" if int(sample[1:]) % 2 == 0 else "control"


def view_model():
    conditions = {"condition": [condition(s) for s in SAMPLES]}
    return build_model(SAMPLES, conditions, {"condition": "categorical"}, ["condition"], {}, "condition", "treated", "control")


def fitted(spark, sf):
    rows = packed(spark, sf)
    genes = rows.count()
    factors = factor_array(size_factors(rows, SAMPLES), SAMPLES)
    kept = rows.filter(F.exists("y", lambda v: v > 0))
    return fit_model(Workspace(spark, "model"), kept, view_model(), factors, "view", genes)


def view_analysis(spark, sf):
    samples = spark.createDataFrame([(i, s, condition(s)) for i, s in enumerate(SAMPLES)], "record int, sample_id string, condition string")
    settings = [("version", "1"), ("design_terms", "condition"), ("alpha", "0.05"), ("filter", "zero_total"), ("shrinkage", "apeglm")]
    contrasts = [(1, "treated_vs_control", "condition", "treated", "control"), (2, "control_vs_treated", "condition", "control", "treated")]
    return run_analysis(
        matrix(spark, sf),
        samples,
        spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(settings)], "record int, key string, value string"),
        spark.createDataFrame(contrasts, "record int, contrast_id string, factor string, numerator string, denominator string"),
        annotation(spark, sf).withColumn("record", F.monotonically_increasing_id()),
    )


@query("dispersion_estimates")
def dispersion_estimates(spark, sf):
    return fitted(spark, sf).genes.select(
        "gene_id", "base_mean", "base_var", "gene_dispersion", "trend_dispersion", "map_dispersion", "dispersion", "dispersion_outlier"
    )


@query("wald_results")
def wald_results(spark, sf):
    fit = fitted(spark, sf)
    return res.independent_filter(res.wald(fit, fit.model.coefficient), 0.05)


@query("shrunken_effects")
def shrunken_effects(spark, sf):
    fit = fitted(spark, sf)
    return res.shrink(fit, res.independent_filter(res.wald(fit, fit.model.coefficient), 0.05), fit.model.coefficient)


@query("analysis_results")
def analysis_results(spark, sf):
    return view_analysis(spark, sf).tables["results"]


@query("analysis_summary")
def analysis_summary(spark, sf):
    return view_analysis(spark, sf).tables["summary"]


@query("analysis_heatmap")
def analysis_heatmap(spark, sf):
    return view_analysis(spark, sf).tables["heatmap_data"]


def embedding_rows(spark, sf):
    """Each vector taken as a gene, each dimension as a sample."""
    return table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("x"))


@query("pca_samples")
def pca_samples(spark, sf):
    """PCA of the embedding dimensions, each vector taken as a gene."""
    vectors = embedding_rows(spark, sf)
    width = vectors.select(F.size("x")).first()[0]
    scores, share = tr.principal_components(vectors, width)
    rows = [(i, float(scores[i, 0]), float(scores[i, 1]), float(share[0]), float(share[1])) for i in range(width)]
    return spark.createDataFrame(rows, "dimension int, PC1 double, PC2 double, PC1_variance double, PC2_variance double")


# A covariance matrix squared often enough, and scaled each time, is the projection on its first eigenvector; what that
# explains is taken off and the rest squared again.
@query(
    "pca_variance",
    """WITH RECURSIVE e AS (SELECT vec_id, UNNEST(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
            c AS (SELECT vec_id, d, v - AVG(v) OVER (PARTITION BY vec_id) AS x FROM e),
            g AS (SELECT a.d AS i, b.d AS j, SUM(a.x * b.x) AS g FROM c a JOIN c b ON a.vec_id = b.vec_id GROUP BY ALL),
            m AS (SELECT LIST(r ORDER BY i) AS m FROM (SELECT i, LIST(g ORDER BY j) AS r FROM g GROUP BY i)),
            total AS (SELECT SUM(g) AS total FROM g WHERE i = j),
            first AS (SELECT 0 AS step, list_transform(m, lambda r: list_transform(r, lambda v: v / total)) AS p FROM m, total
                      UNION ALL
                      SELECT step + 1, list_transform(q, lambda r: list_transform(r, lambda v: v / t)) FROM (
                        SELECT step, q, list_sum(list_transform(range(1, len(q) + 1), lambda k: q[k][k])) AS t FROM (
                          SELECT step, list_transform(p, lambda r: list_transform(p, lambda s: list_dot_product(r, s))) AS q FROM first WHERE step < 36))),
            one AS (SELECT p, list_sum(list_transform(range(1, len(p) + 1), lambda k: list_dot_product(p[k], m[k]))) AS value FROM first, m WHERE step = 36),
            rest AS (SELECT list_transform(range(1, len(p) + 1), lambda a: list_transform(range(1, len(p) + 1), lambda b: m[a][b] - value * p[a][b])) AS m FROM one, m),
            second AS (SELECT 0 AS step, list_transform(rest.m, lambda r: list_transform(r, lambda v: v / total)) AS p FROM rest, total
                      UNION ALL
                      SELECT step + 1, list_transform(q, lambda r: list_transform(r, lambda v: v / t)) FROM (
                        SELECT step, q, list_sum(list_transform(range(1, len(q) + 1), lambda k: q[k][k])) AS t FROM (
                          SELECT step, list_transform(p, lambda r: list_transform(p, lambda s: list_dot_product(r, s))) AS q FROM second WHERE step < 36))),
            two AS (SELECT list_sum(list_transform(range(1, len(p) + 1), lambda k: list_dot_product(p[k], m[k]))) AS value FROM second, m WHERE step = 36)
       SELECT 1 AS component, ROUND(value / total, 8) AS share FROM one, total UNION ALL SELECT 2, ROUND(value / total, 8) FROM two, total""",
)
def pca_variance(spark, sf):
    """Shares of variance of the first two components."""
    vectors = embedding_rows(spark, sf)
    _, share = tr.principal_components(vectors, vectors.select(F.size("x")).first()[0])
    return spark.createDataFrame([(c + 1, float(v)) for c, v in enumerate(share)], "component int, share double").withColumn("share", F.round("share", 8))


@query(
    "gram_embeddings",
    """WITH e AS (SELECT vec_id, UNNEST(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings),
            c AS (SELECT vec_id, d, v - AVG(v) OVER (PARTITION BY vec_id) AS x FROM e)
       SELECT CAST(a.d AS INTEGER) AS i, CAST(b.d AS INTEGER) AS j, ROUND(SUM(a.x * b.x), 6) AS g FROM c a JOIN c b ON a.vec_id = b.vec_id AND a.d <= b.d GROUP BY ALL""",
)
def gram_embeddings(spark, sf):
    return tr.gram(embedding_rows(spark, sf)).withColumn("g", F.round("g", 6))


@query(
    "coefficient_names",
    """SELECT DISTINCT CASE WHEN regexp_matches(f, '^[0-9]') THEN 'X' ELSE '' END || regexp_replace(f, '[^A-Za-z0-9._]', '.', 'g') || '_1.URGENT_vs_' || regexp_replace(o_orderpriority, '[^A-Za-z0-9._]', '.', 'g') AS name
       FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN '2nd' ELSE 'status' || o_orderstatus END AS f FROM orders)""",
)
def coefficient_names(spark, sf):
    factor = F.when(F.col("o_orderstatus") == "F", "2nd").otherwise(F.concat(F.lit("status"), "o_orderstatus"))
    orders = table(spark, sf, "orders").select(factor.alias("f"), "o_orderpriority").distinct()
    return orders.select(coefficient_name(F.col("f"), F.lit("1-URGENT"), F.col("o_orderpriority")).alias("name")).distinct()
