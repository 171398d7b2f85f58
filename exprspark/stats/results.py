"""Contrast results: test statistics, independent filtering, shrinkage, summaries and plot tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.functions.text import neg_log10
from exprspark.operators.compare import close
from exprspark.operators.ordering import adjust_p, exact_quantiles, rejections, top_per_group
from exprspark.stats import kernels as k
from exprspark.stats.fit import Fit, batches, filter_threshold, nullable
from exprspark.stats.special import two_sided_p

# Filter levels and plot sizes.
FILTER_LEVELS = 50
FILTER_TOP = 0.95
HEATMAP_GENES = 50
STRONG_LFC = 2.0


def wald(fit: Fit, coefficient: int) -> DataFrame:
    """Unadjusted results of one coefficient; the p-value of a gene with an outlying count is NULL."""
    at = coefficient + 1
    lfc = F.nanvl(F.element_at("beta", at) * k.LOG2E, F.lit(None))
    se = F.nanvl(F.element_at("se", at) * k.LOG2E, F.lit(None))
    p_value = F.pandas_udf(lambda z: pd.Series(two_sided_p(z.to_numpy(dtype=float))), "double")
    table = fit.genes.select("gene_id", "base_mean", lfc.alias("lfc"), se.alias("se"), "count_outlier").withColumn(
        "stat", F.try_divide("lfc", "se")
    )
    p = F.when(~F.col("count_outlier") & F.col("stat").isNotNull(), p_value(F.coalesce("stat", F.lit(0.0))))
    return table.select(
        "gene_id",
        F.col("base_mean").alias("baseMean"),
        F.col("lfc").alias("log2FoldChange"),
        F.col("se").alias("lfcSE"),
        "stat",
        p.alias("pvalue"),
    )


def filter_levels(results: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Levels from the share of zero means up to 0.95, and the mean counts at them."""
    zero_share = results.agg(F.avg((F.col("baseMean") == 0).cast("double"))).first()[0]
    top = FILTER_TOP if zero_share < FILTER_TOP else 1.0
    levels = np.linspace(zero_share, top, FILTER_LEVELS)
    rows = exact_quantiles(results, "baseMean", [float(v) for v in levels]).collect()
    cutoffs = {r["level"]: r["quantile"] for r in rows}
    return levels, np.array([cutoffs[i] for i in range(len(levels))])


def independent_filter(results: DataFrame, alpha: float) -> DataFrame:
    """Add ``padj``: adjusted over the genes above the mean count that yields the most rejections.

    Each gene is repeated for the levels it passes, and one ranked pass counts rejections at all levels.
    """
    levels, cutoffs = filter_levels(results)
    marks = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(float(c)).alias("cutoff")) for i, c in enumerate(cutoffs)])
    passed = (
        results.filter(F.col("pvalue").isNotNull())
        .select("pvalue", "baseMean", F.inline(marks))
        .filter(F.col("baseMean") >= F.col("cutoff"))
    )
    hits = np.zeros(len(levels))
    for row in rejections(passed, "pvalue", ["level"], alpha).collect():
        hits[row["level"]] = row["rejections"]
    cutoff = float(cutoffs[filter_threshold(levels, hits)])
    tested = results.withColumn("tested", F.when(F.col("baseMean") >= cutoff, F.col("pvalue")))
    return adjust_p(tested, "tested").drop("tested")


def prior_scale(estimates: DataFrame) -> float:
    """Spread of true effects beyond their standard errors, for ``estimates(s, d)``: squares of both.

    The root of a monotone weighted mean is bracketed by evaluating many candidates per job: each gene is
    repeated per candidate and reduced to one row per candidate before the shuffle.
    """
    low, high = 1e-6, 400.0
    w = 1 / (2 * (F.col("a") + F.col("d")) * (F.col("a") + F.col("d")))

    def gaps(candidates: np.ndarray) -> np.ndarray:
        marks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(a)).alias("a")) for i, a in enumerate(candidates)])
        rows = (
            estimates.select("s", "d", F.inline(marks)).groupBy("i")
            .agg((F.sum((F.col("s") - F.col("d")) * w) / F.sum(w)).alias("mean")).collect()
        )
        found = {r["i"]: r["mean"] for r in rows}
        return np.array([found[i] for i in range(len(candidates))]) - candidates

    for _ in range(3):
        grid = np.exp(np.linspace(np.log(low), np.log(high), 65))
        value = gaps(grid)
        if value[0] <= 0:
            return float(np.sqrt(low))
        below = np.flatnonzero(value <= 0)
        if not len(below):
            return float(np.sqrt(high))
        i = below[0]
        low, high = grid[i - 1], grid[i]
        edge = value[i - 1: i + 1]
    root = low + (high - low) * edge[0] / (edge[0] - edge[1])
    return float(np.sqrt(root))


def shrink(fit: Fit, results: DataFrame, coefficient: int) -> DataFrame:
    """Shrunken effects beside the unshrunken p-values: a Cauchy prior scaled by all genes' estimates."""
    at = coefficient + 1
    beta, se = F.element_at("beta", at), F.element_at("se", at)
    usable = fit.genes.filter(~F.isnan(beta) & (se > 0))
    scale = min(1.0, prior_scale(usable.select((beta * beta).alias("s"), (se * se).alias("d"))))
    x, sf = fit.model.matrix, fit.size_factors

    def run(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            if not len(table):
                continue
            y = batches(table, len(sf))
            mle = np.stack(table["beta"].to_numpy())
            ok = np.isfinite(mle).all(axis=1)
            lfc, sd = np.full(len(y), np.nan), np.full(len(y), np.nan)
            if ok.any():
                alpha = table["dispersion"].to_numpy(dtype=float)[ok]
                lfc[ok], sd[ok] = k.shrink_coefficient(y[ok], x, sf, alpha, coefficient, scale, mle[ok])
            yield pd.DataFrame({"gene_id": table["gene_id"].to_numpy(), "log2FoldChange": nullable(lfc), "lfcSE": nullable(sd)})

    modes = fit.genes.select("gene_id", "y", "beta", "dispersion").mapInPandas(
        run, "gene_id string, log2FoldChange double, lfcSE double"
    )
    kept = results.select("gene_id", "baseMean", "pvalue", "padj")
    return kept.join(modes, "gene_id").select("gene_id", "baseMean", "log2FoldChange", "lfcSE", "pvalue", "padj")


def coefficient_mismatches(contrast: DataFrame, named: DataFrame) -> DataFrame:
    """Cells where a requested contrast and the coefficient of that name disagree."""
    columns = [c for c in contrast.columns if c != "gene_id"]
    joined = contrast.alias("a").join(named.alias("b"), "gene_id", "full_outer")
    wrong = F.lit(False)
    for c in columns:
        wrong = wrong | ~close(F.col(f"a.{c}"), F.col(f"b.{c}"))
    return joined.filter(wrong).select("gene_id")


def is_significant(alpha: float):
    return F.coalesce(F.col("padj") < alpha, F.lit(False))


def volcano(results: DataFrame, shrunken: DataFrame, alpha: float) -> DataFrame:
    effects = shrunken.select("gene_id", "log2FoldChange")
    return results.select("gene_id", "padj").join(effects, "gene_id").select(
        "gene_id", "log2FoldChange", "padj", neg_log10(F.col("padj")).alias("neg_log10_padj"), is_significant(alpha).alias("significant")
    )


def ma_data(results: DataFrame, alpha: float, by: list[str] | None = None) -> DataFrame:
    return results.select(*(by or []), "gene_id", "baseMean", "log2FoldChange", is_significant(alpha).alias("significant"))


def dispersion_data(fit: Fit) -> DataFrame:
    return fit.genes.select(
        "gene_id", F.col("base_mean").alias("baseMean"), "gene_dispersion", "trend_dispersion", "dispersion"
    )


def top_significant(results: DataFrame, alpha: float, k_top: int = HEATMAP_GENES, by: list[str] | None = None) -> DataFrame:
    kept = results.filter(is_significant(alpha)).select(*(by or []), "gene_id", "padj")
    return top_per_group(kept, k_top, [F.col("padj"), F.col("gene_id")], by)


def heatmap(results: DataFrame, values: DataFrame, alpha: float, by: list[str] | None = None) -> DataFrame:
    """Values of the top significant genes, with their rank. One contrast's list has at most fifty rows; Spark sizes those of groups."""
    by = by or []
    top = top_significant(results, alpha, by=by).select(*by, "gene_id", "rank")
    return values.join(top if by else F.broadcast(top), "gene_id")


def summary(results: DataFrame, by: list[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """Up, down, strong, outlier and low-count genes with their share of all tested genes."""
    tested = F.count_if(F.col("baseMean") > 0)
    hit = is_significant(alpha)
    counts = {
        "genes": tested,
        "up": F.count_if(hit & (F.col("log2FoldChange") > 0)),
        "down": F.count_if(hit & (F.col("log2FoldChange") < 0)),
        "strong": F.count_if(hit & (F.abs("log2FoldChange") > STRONG_LFC)),
        "outliers": F.count_if((F.col("baseMean") > 0) & F.col("pvalue").isNull()),
        "low_counts": F.count_if(F.col("pvalue").isNotNull() & F.col("padj").isNull()),
    }
    table = results.groupBy(*(by or [])).agg(*[v.alias(n) for n, v in counts.items()])
    share = {f"{n}_percent": 100.0 * F.try_divide(F.col(n).cast("double"), F.col("genes").cast("double")) for n in counts if n != "genes"}
    return table.withColumns(share)


def contrast_summary(results: DataFrame, facts: dict[str, str], alpha: float, by: list[str] | None = None) -> DataFrame:
    """Key/value rows of one contrast, or of each group: given facts first, then counts from the results."""
    by = by or []
    counted = results.groupBy(*by).agg(
        F.count(F.lit(1)).cast("string").alias("genes_retained"),
        F.count_if(is_significant(alpha)).cast("string").alias("significant"),
        F.count_if(F.col("padj").isNull()).cast("string").alias("padj_na"),
    )
    pairs = [F.struct(F.lit(n).alias("key"), F.lit(v).alias("value")) for n, v in facts.items()]
    pairs += [F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in counted.columns if n not in by]
    return counted.select(*by, F.inline(F.array(*pairs)))
