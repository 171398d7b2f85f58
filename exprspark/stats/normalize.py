"""Size factors, normalized counts and per-gene moments as column programs over the long matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.operators.ordering import exact_quantiles


def log_ratios(packed: DataFrame) -> DataFrame:
    """``ln count`` minus the gene's mean ``ln count`` as ``(ordinal, log_ratio)``.

    Only genes counted in every sample take part. All of a gene sits in one row, so nothing is shuffled.
    """
    logs = packed.filter(F.forall("y", lambda v: v > 0)).select(F.transform("y", F.ln).alias("logs"))
    mean = F.aggregate("logs", F.lit(0.0), lambda a, v: a + v) / F.size("logs")
    return logs.select("logs", mean.alias("mean")).select(
        F.posexplode(F.transform("logs", lambda v: v - F.col("mean"))).alias("ordinal", "log_ratio")
    )


def size_factors(packed: DataFrame, sample_ids: list[str]) -> DataFrame:
    """Median-of-ratios size factor per sample: ``(sample_id, size_factor)`` for ``packed(gene_id, y)``.

    With no gene counted everywhere the result is empty.
    """
    medians = exact_quantiles(log_ratios(packed), "log_ratio", [0.5], ["ordinal"])
    names = F.array(*[F.lit(s) for s in sample_ids])
    return medians.select(names[F.col("ordinal")].alias("sample_id"), F.exp("quantile").alias("size_factor"))


def normalized(packed: DataFrame, factors: DataFrame, sample_ids: list[str]) -> DataFrame:
    """Counts over size factors in long form ``(gene_id, sample_id, value)``; the factors join by sample."""
    names = F.array(*[F.lit(s) for s in sample_ids])
    cells = packed.select("gene_id", F.posexplode("y").alias("ordinal", "c"))
    joined = cells.select("gene_id", names[F.col("ordinal")].alias("sample_id"), "c").join(factors, "sample_id")
    return joined.select("gene_id", "sample_id", (F.col("c") / F.col("size_factor")).alias("value"))


def base_moments(values: DataFrame) -> DataFrame:
    """Mean and sample variance of normalized counts per gene."""
    return values.groupBy("gene_id").agg(F.avg("value").alias("base_mean"), F.var_samp("value").alias("base_var"))


def vst_parametric(q: Column, a0: float | Column, a1: float | Column) -> Column:
    """Variance-stabilized value of a normalized count for the trend ``a0 + a1 / mean``."""
    a0, a1 = (c if isinstance(c, Column) else F.lit(float(c)) for c in (a0, a1))
    root = F.sqrt(a0 * q * (a1 + 1 + a0 * q))
    return F.log2((1 + a1 + 2 * a0 * q + 2 * root) / (4 * a0))
