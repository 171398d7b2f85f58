"""Dispersion and coefficient estimation for all genes of one model.

Three passes, each over a written table: gene-wise dispersions in tasks, trend and prior width as small
Spark aggregates, then posterior dispersions, coefficients and outlier handling in tasks.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.operators.ordering import exact_quantiles
from exprspark.session import Workspace
from exprspark.stats import kernels as k
from exprspark.stats.design import Model
from exprspark.stats.special import f_quantile, local_line, log_chi2_histogram, lowess, trigamma

# Fixed values of the published method.
TREND_START = (0.1, 1.0)
TREND_RESIDUALS = (1e-4, 15.0)
TREND_ROUNDS = 10
MIN_PRIOR_VAR = 0.25
OUTLIER_SD = 2.0
MAD_SCALE = 1.4826
COOKS_PROB = 0.99
REPLACE_REPLICATES = 7
REPLACE_TRIM = 0.2
USABLE_DISPERSION = 100 * k.MIN_DISPERSION


class FitError(ValueError):
    pass


@dataclass
class Trend:
    """Dispersion as a function of the mean: ``a0 + a1 / mean``, or interpolation on a log grid."""

    a0: float = float("nan")
    a1: float = float("nan")
    log_mean: np.ndarray | None = None
    log_dispersion: np.ndarray | None = None

    @property
    def parametric(self) -> bool:
        return self.log_mean is None

    def __call__(self, mean: np.ndarray) -> np.ndarray:
        if self.parametric:
            return self.a0 + self.a1 / mean
        return np.exp(np.interp(np.log(mean), self.log_mean, self.log_dispersion))


@dataclass
class Fit:
    genes: DataFrame
    model: Model
    size_factors: np.ndarray
    trend: Trend
    prior_var: float
    residual_var: float
    gene_count: int | None = None


def batches(table: pd.DataFrame, n: int) -> np.ndarray:
    y = np.stack(table["y"].to_numpy()).astype(float)
    if y.shape[1] != n:
        raise FitError("a gene does not have one count per sample")
    return y


def lists(a: np.ndarray) -> list[np.ndarray]:
    return list(a)


def nullable(a: np.ndarray) -> pd.Series:
    """Floats with NULL, not NaN, where a value is missing."""
    return pd.Series(pd.array(a, dtype="Float64"))


def task_count(df: DataFrame, genes: int, samples: int) -> int:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return int(max(min(cores, -(-genes // 128)), genes * samples // 2_000_000, 1))


CELLS_PER_BATCH = 4_000_000


def bound_batches(df: DataFrame, samples: int) -> None:
    """Keep the Arrow batches of the fits at a bounded number of cells, however many samples a gene row has."""
    rows = max(1, min(4096, CELLS_PER_BATCH // samples))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


GENEWISE = "gene_id string, y array<double>, mu array<double>, base_mean double, base_var double, gene_dispersion double"


def genewise(packed: DataFrame, model: Model, sf: np.ndarray) -> DataFrame:
    x = model.matrix

    def run(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            if not len(table):
                continue
            y = batches(table, len(sf))
            q = y / sf
            dispersion, mu = k.genewise_dispersion(y, x, sf)
            yield pd.DataFrame(
                {
                    "gene_id": table["gene_id"],
                    "y": lists(y),
                    "mu": lists(mu),
                    "base_mean": q.mean(axis=1),
                    "base_var": q.var(axis=1, ddof=1),
                    "gene_dispersion": dispersion,
                }
            )

    return packed.mapInPandas(run, GENEWISE)


def parameters(**values: float) -> str:
    """Numbers as columns of a one-row generator instead of literals, so that an iteration only changes data
    and Spark reuses the compiled plan of the round before."""
    return "inline(array(named_struct(" + ", ".join(f"'{k}', {float(v)!r}D" for k, v in values.items()) + ")))"


# Normal equations of gamma-weighted least squares on (1, 1/m), the deviance, and means that are not positive.
TREND_SUMS = [
    "sum(w)", "sum(w / m)", "sum(w / (m * m))", "sum(w * d)", "sum(w * d / m)",
    "sum(if(mu > 0, -2 * (ln(d / mu) - (d - mu) / mu), null))", "count_if(mu <= 0)",
]


def trend_sums(points: DataFrame, now: tuple[float, float], mask: tuple[float, float]) -> np.ndarray:
    """Sums of one step of the gamma regression at ``now``, over the genes near the trend ``mask``."""
    low, high = TREND_RESIDUALS
    given = parameters(now0=now[0], now1=now[1], mask0=mask[0], mask1=mask[1])
    row = (
        points.selectExpr("base_mean AS m", "gene_dispersion AS d", given)
        .where(f"d / (mask0 + mask1 / m) > {low!r}D AND d / (mask0 + mask1 / m) < {high!r}D")
        .selectExpr("m", "d", "now0 + now1 / m AS mu", "1 / ((now0 + now1 / m) * (now0 + now1 / m)) AS w")
        .selectExpr(*TREND_SUMS)
        .first()
    )
    if row[0] is None or row[6]:
        raise FitError("dispersion trend left its valid range")
    return np.array([float(v) for v in row[:6]])


def fit_parametric(points: DataFrame) -> Trend:
    """Gamma regression of dispersion on 1/mean, repeated while genes far off the trend are set aside."""
    now = TREND_START
    for _ in range(TREND_ROUNDS + 1):
        mask, current = now, now
        sums = trend_sums(points, current, mask)
        for _ in range(25):
            normal = np.array([[sums[0], sums[1]], [sums[1], sums[2]]])
            current = tuple(np.linalg.solve(normal, sums[3:5]))
            previous = sums[5]
            sums = trend_sums(points, current, mask)
            if abs(sums[5] - previous) / (abs(sums[5]) + 0.1) < 1e-8:
                break
        if min(current) <= 0:
            raise FitError("dispersion trend is not positive")
        change = float(np.sum(np.log(np.array(current) / np.array(mask)) ** 2))
        now = current
        if change < 1e-6:
            return Trend(*now)
    raise FitError("dispersion trend did not settle")


def fit_local(points: DataFrame, bins: int = 400) -> Trend:
    """Local regression of log dispersion on log mean over bins of equal width in log mean."""
    logs = points.select(F.ln("base_mean").alias("x"), F.ln("gene_dispersion").alias("y"), F.col("base_mean").alias("w"))
    ends = logs.agg(F.min("x"), F.max("x")).first()
    width = max((ends[1] - ends[0]) / bins, 1e-9)
    rows = (
        logs.groupBy(F.least(F.floor((F.col("x") - ends[0]) / width), F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("w"), F.sum(F.col("w") * F.col("x")), F.sum(F.col("w") * F.col("y")))
        .orderBy("bin")
        .collect()
    )
    table = np.array([[float(v) for v in r[1:]] for r in rows])
    x, y = table[:, 1] / table[:, 0], table[:, 2] / table[:, 0]
    grid = np.linspace(ends[0], ends[1], bins)
    fitted = local_line(x, y, table[:, 0], grid, 0.7) if len(x) > 2 else np.full(bins, y.mean())
    return Trend(log_mean=grid, log_dispersion=fitted)


def fit_trend(genes: DataFrame) -> Trend:
    points = genes.select("base_mean", "gene_dispersion").filter(F.col("gene_dispersion") >= USABLE_DISPERSION)
    if points.limit(1).count() == 0:
        raise FitError("all gene-wise dispersions lie within two orders of the minimum")
    try:
        return fit_parametric(points)
    except (FitError, np.linalg.LinAlgError) as failed:
        warnings.warn(f"local instead of parametric dispersion trend: {failed}", stacklevel=2)
        return fit_local(points)


def residual_column(trend: Trend):
    if trend.parametric:
        return F.ln("gene_dispersion") - F.ln(F.lit(trend.a0) + F.lit(trend.a1) / F.col("base_mean"))
    curve = F.pandas_udf(lambda m: pd.Series(np.log(trend(m.to_numpy()))), "double")
    return F.ln("gene_dispersion") - curve("base_mean")


def prior_width(genes: DataFrame, trend: Trend, residual_df: int) -> tuple[float, float]:
    """Variance of log residuals around the trend (robust), and the prior variance left after sampling noise."""
    residuals = genes.filter(F.col("gene_dispersion") >= USABLE_DISPERSION).select(residual_column(trend).alias("r"))
    middle = exact_quantiles(residuals, "r", [0.5]).first()["quantile"]
    gaps = residuals.selectExpr("r", parameters(middle=middle)).selectExpr("abs(r - middle) AS d")
    spread = exact_quantiles(gaps, "d", [0.5]).first()["quantile"]
    residual_var = float((MAD_SCALE * spread) ** 2)
    if residual_df <= 3:
        return residual_var, matched_width(residuals, residual_df)
    return residual_var, max(residual_var - trigamma(residual_df / 2.0), MIN_PRIOR_VAR)


def matched_width(residuals: DataFrame, residual_df: int) -> float:
    """With few residual degrees of freedom: the width whose expected residual histogram is nearest.

    Distance is the Kullback-Leibler divergence over bins of 0.5 between -10 and 10, smoothed over the
    grid of widths. The expected histogram is computed, not simulated.
    """
    edges = np.arange(-20, 21) / 2.0
    rows = (
        residuals.filter((F.col("r") > -10) & (F.col("r") < 10))
        .groupBy(F.floor((F.col("r") + 10) * 2).cast("int").alias("bin"))
        .count()
        .collect()
    )
    observed = np.zeros(len(edges) - 1)
    for r in rows:
        observed[r["bin"]] = r["count"]
    observed = observed / observed.sum() / 0.5
    widths = np.linspace(0, 8, 200)
    distance = []
    for v in widths:
        expected = log_chi2_histogram(residual_df, float(np.sqrt(v)), edges)
        positive = np.concatenate([observed[observed > 0], expected[expected > 1e-12]])
        small = positive.min()
        distance.append(np.sum(observed * (np.log(observed + small) - np.log(expected + small))))
    fine = np.linspace(0, 8, 1000)
    smooth = local_line(widths, np.array(distance), np.ones(len(widths)), fine, 0.2)
    return max(float(fine[np.argmin(smooth)]), MIN_PRIOR_VAR)


FITTED = (
    "gene_id string, y array<double>, base_mean double, base_var double, gene_dispersion double, "
    "trend_dispersion double, map_dispersion double, dispersion double, dispersion_outlier boolean, "
    "beta array<double>, se array<double>, converged boolean, max_cooks double, count_outlier boolean, "
    "replaced boolean"
)


@dataclass
class GeneFitter:
    """Everything a task needs to fit a batch once trend and prior are known."""

    model: Model
    sf: np.ndarray
    trend: Trend
    prior_var: float
    residual_var: float

    def dispersions(self, y, mu, mean, gene_disp) -> dict:
        fitted = self.trend(mean)
        mode = k.map_dispersion(y, mu, self.model.matrix, fitted, self.prior_var)
        outlier = np.log(gene_disp) > np.log(fitted) + OUTLIER_SD * np.sqrt(self.residual_var)
        return {
            "gene_dispersion": gene_disp, "trend_dispersion": fitted, "map_dispersion": mode,
            "dispersion": np.where(outlier, gene_disp, mode), "dispersion_outlier": outlier,
        }

    def fit(self, y, mu, gene_disp) -> dict:
        q = y / self.sf
        mean = q.mean(axis=1)
        out = self.dispersions(y, mu, mean, gene_disp)
        found = k.fit_means(y, self.model.matrix, self.sf, out["dispersion"])
        out |= {"y": y, "base_mean": mean, "base_var": q.var(axis=1, ddof=1), **found}
        return out

    def fit_with_outliers(self, y, mu, gene_disp) -> dict:
        """Fit, flag counts with a large Cook's distance, and refit genes whose cells can spare them."""
        n, p = self.model.matrix.shape
        out = self.fit(y, mu, gene_disp)
        genes = len(y)
        out["max_cooks"], out["count_outlier"] = np.full(genes, np.nan), np.zeros(genes, bool)
        out["replaced"] = np.zeros(genes, bool)
        checked, replaceable = self.model.in_cells_of(3), self.model.in_cells_of(REPLACE_REPLICATES)
        if not checked.any():
            return out
        q = y / self.sf
        cooks = k.cooks_distance(y, q, out, self.model.cells, p)
        cutoff = f_quantile(COOKS_PROB, p, n - p)
        if replaceable.any():
            spare = (cooks > cutoff) & replaceable
            rows = np.flatnonzero((cooks > cutoff).any(axis=1))
            middle = k.trimmed_mean(q, REPLACE_TRIM)
            fresh = np.where(spare, np.floor(middle[:, None] * self.sf), y)[rows]
            self.refit(out, rows, fresh)
            cooks = np.where(replaceable, 0.0, cooks)
        top = cooks[:, checked].max(axis=1)
        flagged = top > cutoff
        if self.model.two_groups_only and flagged.any():
            worst = y[np.arange(genes), cooks.argmax(axis=1)]
            flagged &= (y > worst[:, None]).sum(axis=1) < 3
        out["max_cooks"], out["count_outlier"] = top, flagged
        return out

    def refit(self, out: dict, rows: np.ndarray, fresh: np.ndarray) -> None:
        """Replace the fits of some genes by fits to their repaired counts; a gene left without counts has none."""
        out["replaced"][rows] = True
        empty = fresh.sum(axis=1) == 0
        gone, kept = rows[empty], rows[~empty]
        if len(kept):
            y = fresh[~empty]
            gene_disp, mu = k.genewise_dispersion(y, self.model.matrix, self.sf)
            again = self.fit(y, mu, gene_disp)
            for name, value in again.items():
                if name not in ("y", "hat", "mu"):
                    out[name][kept] = value
        for name in ("base_mean", "base_var"):
            out[name][gone] = 0.0
        for name in ("gene_dispersion", "trend_dispersion", "map_dispersion", "dispersion", "beta", "se"):
            out[name][gone] = np.nan

    def __call__(self, tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            if not len(table):
                continue
            y = batches(table, len(self.sf))
            mu = np.stack(table["mu"].to_numpy())
            out = self.fit_with_outliers(y, mu, table["gene_dispersion"].to_numpy(dtype=float).copy())
            scalar = ("base_mean", "base_var", "gene_dispersion", "trend_dispersion", "map_dispersion", "dispersion", "max_cooks")
            frame = {"gene_id": table["gene_id"].to_numpy(), "y": lists(y)}
            frame |= {name: nullable(out[name]) for name in scalar}
            frame |= {name: out[name] for name in ("dispersion_outlier", "converged", "count_outlier", "replaced")}
            frame |= {name: lists(out[name]) for name in ("beta", "se")}
            order = [c.strip().split(" ")[0] for c in FITTED.split(", ")]
            yield pd.DataFrame(frame)[order]


def fit_model(ws: Workspace, packed: DataFrame, model: Model, sf: np.ndarray, name: str, genes: int) -> Fit:
    """Fit all genes of ``packed(gene_id, y)``; ``y`` follows the model's sample order."""
    bound_batches(packed, len(sf))
    tasks = task_count(packed, genes, len(sf))
    first = ws.save(genewise(packed.repartition(tasks, "gene_id"), model, sf), f"{name}-genewise")
    trend = fit_trend(first)
    residual_var, prior_var = prior_width(first, trend, model.residual_df)
    fitter = GeneFitter(model, sf, trend, prior_var, residual_var)
    inputs = first.select("gene_id", "y", "mu", "gene_dispersion").repartition(tasks, "gene_id")
    fitted = ws.save(inputs.mapInPandas(fitter, FITTED), f"{name}-fitted")
    return Fit(fitted, model, sf, trend, prior_var, residual_var, genes)


Scorer = Callable[[float], float]


def filter_threshold(quantile_levels: np.ndarray, hits: np.ndarray) -> int:
    """Which filter level to use: the first whose rejections come near the smoothed maximum."""
    if hits.max() <= 10:
        return 0
    smooth = lowess(quantile_levels, hits.astype(float), 0.2)
    some = hits > 0
    error = np.sqrt(np.mean((hits[some] - smooth[some]) ** 2)) if some.any() else 0.0
    above = np.flatnonzero(hits > smooth.max() - error)
    return int(above[0]) if len(above) else 0
