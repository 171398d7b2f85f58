"""Model kernels against independent answers, and properties of a whole analysis."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from exprspark.operators.checks import ContractError
from exprspark.plans.analysis import run_analysis
from exprspark.sources.counts import read_matrix
from exprspark.stats import kernels as k
from exprspark.stats import special as sp
from exprspark.stats import transform as tr
from exprspark.stats.design import build_model, model_groups
from exprspark.stats.fit import GeneFitter, Trend, filter_threshold, fit_local, fit_trend, matched_width, residual_column
from exprspark.stats.normalize import vst_parametric
from tests.fixtures import DOWN, EMPTY, SPARSE, UP, simulated_counts

SAMPLES = [f"sample_{i}" for i in range(1, 9)]
CONDITION = ["control"] * 4 + ["treated"] * 4
BATCH = ["A", "B"] * 4


def test_special_functions():
    for x in (0.01, 0.5, 3.0, 12.0, 1e5):
        want = math.lgamma(x) - ((x - 0.5) * math.log(x) - x + sp.HALF_LOG_2PI)
        assert abs(sp.stirling_rest(np.array([x]))[0] - want) < 1e-8 * max(1, abs(want))
    for y, alpha in ((0, 0.1), (7, 0.3), (500, 1e-8), (40, 5.0)):
        want = sum(math.log1p(i * alpha) for i in range(y))
        assert sp.log_rising(np.array([float(y)]), np.array([alpha]))[0] == pytest.approx(want, rel=1e-9, abs=1e-12)
    assert sp.trigamma(1.0) == pytest.approx(math.pi**2 / 6, rel=1e-12)
    assert sp.beta_cdf(0.3, 2, 3) == pytest.approx(0.3483, rel=1e-10)
    # For two and d degrees of freedom the F quantile has a closed form.
    assert sp.f_quantile(0.99, 2, 5) == pytest.approx(2.5 * (0.01 ** (-0.4) - 1), rel=1e-9)
    assert sp.two_sided_p(np.array([0.0, 1.959963984540054]))[1] == pytest.approx(0.05, rel=1e-9)
    x = np.concatenate([np.linspace(0, 6, 2001), np.linspace(6, 26, 500)])
    want = np.array([math.erfc(v) for v in x])
    assert np.max(np.abs(sp.erfc_positive(x) / want - 1)) < 1e-14
    assert sp.erfc_positive(np.array([np.inf, 50.0]))[0] == 0.0 and np.isnan(sp.erfc_positive(np.array([np.nan]))[0])
    hist = sp.log_chi2_histogram(2, 0.7, np.arange(-20, 21) / 2.0)
    draws = np.log(np.random.default_rng(0).chisquare(2, 200_000) / 2) + np.random.default_rng(1).normal(0, 0.7, 200_000)
    assert np.abs(hist - np.histogram(draws, np.arange(-20, 21) / 2.0, density=True)[0]).max() < 0.01


def sample_batch(genes=60):
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(8), np.repeat([0.0, 1.0], 4)])
    mean = rng.uniform(5, 300, genes)[:, None] * np.exp(x[:, 1] * rng.normal(0, 1, genes)[:, None])
    return rng.negative_binomial(8, 8 / (8 + mean)).astype(float), x, rng.uniform(0.7, 1.4, 8)


def test_dispersions_are_the_profile_maximum():
    y, x, sf = sample_batch()
    disp, mu = k.genewise_dispersion(y, x, sf)
    grid = np.linspace(math.log(1e-8), math.log(10), 4000)
    table = np.stack([k.adjusted_profile(np.full(len(y), g), y, mu, x) for g in grid])
    best = np.exp(grid[table.argmax(axis=0)])
    inside = (best > 1e-6) & (best < 9)
    assert inside.sum() > 40 and np.abs(np.log(disp[inside] / best[inside])).max() < 0.01
    mode = k.map_dispersion(y, mu, x, np.full(len(y), 0.1), 0.5)
    table -= ((grid - math.log(0.1)) ** 2)[:, None]
    assert np.abs(np.log(mode / np.exp(grid[table.argmax(axis=0)]))).max() < 0.01


def test_coefficients_solve_the_score_equations():
    y, x, sf = sample_batch()
    fit = k.fit_means(y, x, sf, np.full(len(y), 0.12))
    assert fit["converged"].all()
    score = ((y - fit["mu"]) / (1 + 0.12 * fit["mu"])) @ x
    free = (fit["mu"] > 0.5).all(axis=1)
    assert np.abs(score[free] / y[free].sum(axis=1, keepdims=True)).max() < 1e-4
    w = fit["mu"] / (1 + 0.12 * fit["mu"])
    info = np.einsum("gn,np,nq->gpq", w, x, x)
    assert np.allclose(fit["se"], np.sqrt(np.diagonal(np.linalg.inv(info), axis1=1, axis2=2)), rtol=1e-4)
    other = k.fit_means(y, np.column_stack([x[:, 0], 1 - x[:, 1]]), sf, np.full(len(y), 0.12))
    assert np.abs(fit["beta"][:, 1] + other["beta"][:, 1]).max() < 1e-4


def test_shrinkage_finds_the_posterior_mode():
    y, x, sf = sample_batch(12)
    alpha = np.full(len(y), 0.12)
    mle = k.fit_means(y, x, sf, alpha)["beta"]
    lfc, sd = k.shrink_coefficient(y, x, sf, alpha, 1, 0.4, mle)
    for g in range(len(y)):
        b1 = np.linspace(-6, 6, 1201)
        best = []
        for b in b1:
            b0 = mle[g, 0] + np.linspace(-2, 2, 401)
            mu = sf * np.exp(b0[:, None] + b * x[:, 1])
            ll = k.nb_log_likelihood(np.tile(y[g], (401, 1)), mu, np.full((401, 1), 0.12))
            best.append((ll - 0.5 * (b0 / 15) ** 2).max() - math.log1p((b / 0.4) ** 2))
        assert lfc[g] / k.LOG2E == pytest.approx(b1[int(np.argmax(best))], abs=0.02)
    assert (np.abs(lfc) <= np.abs(mle[:, 1]) * k.LOG2E + 1e-6).all() and (sd > 0).all()


def model(terms, factor="condition", num="treated", den="control", references=None, batch=BATCH, condition=CONDITION):
    types = {"condition": "categorical", "batch": "categorical", "age": "numeric"}
    values = {"condition": condition, "batch": batch, "age": [float(i) for i in range(8)]}
    return build_model(SAMPLES, values, types, terms, references or {"batch": "A"}, factor, num, den)


def test_designs():
    m = model(["batch", "condition"])
    assert m.names == ["(Intercept)", "batchB", "conditiontreated"] and m.coefficient == 2
    assert m.coefficient_name == "condition_treated_vs_control" and m.residual_df == 5
    assert m.matrix[:, 1].tolist() == [0, 1] * 4 and m.matrix[:, 2].tolist() == [0] * 4 + [1] * 4
    three = ["A"] * 3 + ["B"] * 3 + ["C"] * 2
    fits = [model(["condition"], num=n, den=d, condition=three) for n, d in (("B", "A"), ("C", "A"), ("A", "B"))]
    assert model_groups(fits) == [0, 0, 1]
    for broken in (
        dict(terms=["batch", "condition"], batch=["A"] * 4 + ["B"] * 4),
        dict(terms=["batch", "condition"], batch=list("ABCDDEFG")),
        dict(terms=["batch", "condition"], batch=["A"] * 8),
        dict(terms=["condition"], condition=["control"] * 4 + ["treated"] * 2 + ["a b", "a.b"]),
        dict(terms=["condition"], num="absent"),
    ):
        with pytest.raises(ContractError):
            model(**broken)


def test_filter_threshold():
    levels = np.linspace(0, 0.95, 50)
    assert filter_threshold(levels, np.zeros(50)) == 0
    rising = np.round(100 * np.sin(np.linspace(0.2, 2.6, 50))).astype(float)
    picked = filter_threshold(levels, rising)
    # A smooth series leaves little residual, so the first level near the top is just before the peak.
    assert picked <= rising.argmax() and rising[picked] > 0.95 * rising.max()
    noisy = rising + np.where(np.arange(50) % 2 == 0, 12.0, -12.0)
    assert filter_threshold(levels, noisy) < picked


def test_vst_derivative_identity(spark):
    a0, a1, h = 0.03, 1.7, 1e-4
    for q in (0.5, 20.0, 5000.0):
        lo, hi = spark.range(1).select(*[vst_parametric(F.lit(v), a0, a1) for v in (q - h, q + h)]).first()
        assert (hi - lo) / (2 * h) * math.log(2) * math.sqrt(q + a1 * q + a0 * q * q) == pytest.approx(math.sqrt(a0), rel=1e-5)


def packed_rows(spark, x):
    return spark.createDataFrame([(f"g{i}", [float(v) for v in row]) for i, row in enumerate(x)], "gene_id string, x array<double>").repartition(5)


def svd_scores(x, components=2):
    u, s, _ = np.linalg.svd((x - x.mean(axis=1, keepdims=True)).T, full_matrices=False)
    return u[:, :components] * s[:components], s[:components] ** 2 / (s**2).sum()


@pytest.mark.parametrize("genes, samples, block", [(200, 6, 8), (200, 6, 2), (300, 90, 8), (40, 90, 3), (500, 33, 4)])
def test_components_match_svd(spark, genes, samples, block):
    x = np.random.default_rng(genes + samples).normal(size=(genes, samples)) * (1 + np.arange(samples) / samples)
    scores, share = tr.principal_components(packed_rows(spark, x), samples, block=block)
    want, want_share = svd_scores(x)
    assert np.abs(np.abs(scores) - np.abs(want)).max() < 1e-8 * np.abs(want).max()
    assert np.abs(share - want_share).max() < 1e-10
    assert all(scores[np.argmax(np.abs(scores[:, c])), c] > 0 for c in range(2))


def test_components_of_degenerate_tables(spark):
    x = np.random.default_rng(4).normal(size=(200, 6))
    scores, share = tr.principal_components(packed_rows(spark, x[:1]), 6)
    assert np.abs(scores[:, 1]).max() == 0 and share[1] == 0 and share[0] == pytest.approx(1)
    for rows in (np.ones((5, 6)), np.zeros((0, 6))):
        scores, share = tr.principal_components(packed_rows(spark, rows), 6)
        assert not scores.any() and not share.any()
    # Two equal eigenvalues: any basis of their plane will do.
    pair = np.zeros((2, 4))
    pair[0, :2], pair[1, 2:] = (1, -1), (1, -1)
    scores, share = tr.principal_components(packed_rows(spark, pair), 4)
    assert share == pytest.approx([0.5, 0.5]) and np.abs(scores @ scores.T - pair.T @ pair).max() < 1e-9


@pytest.mark.parametrize("tile, held", [(32, 1 << 22), (4, 64), (1, 1)])
def test_gram_tiles_and_distances(spark, tile, held):
    x = np.random.default_rng(7).normal(size=(60, 9))
    arrays = packed_rows(spark, x)
    centered = x - x.mean(axis=1, keepdims=True)
    got = {(r.i, r.j): r.g for r in tr.gram(arrays, True, tile, held).collect()}
    want = centered.T @ centered
    assert set(got) == {(i, j) for i in range(9) for j in range(i, 9)}
    assert max(abs(got[k] - want[k]) for k in got) < 1e-9
    order = spark.createDataFrame([(i, f"s{i}") for i in range(9)], "at int, sample_id string")
    found = {(r.sample_a, r.sample_b): r.distance for r in tr.sample_distances(arrays, order).collect()}
    assert len(found) == 81
    apart = np.sqrt(((x.T[:, None, :] - x.T[None, :, :]) ** 2).sum(axis=2))
    assert max(abs(found[f"s{i}", f"s{j}"] - apart[i, j]) for i in range(9) for j in range(9)) < 1e-6
    assert tr.gram(arrays.limit(0)).count() == 0


def inputs(spark, counts, contrasts, alpha="0.05"):
    genes = [f"gene_{i:04d}" for i in range(1, len(counts) + 1)]
    rows = [(g, s, int(c)) for g, row in zip(genes, counts) for s, c in zip(SAMPLES, row)]
    settings = {"version": "1", "design_terms": "batch,condition", "alpha": alpha, "filter": "zero_total", "shrinkage": "apeglm",
                "type.batch": "categorical", "reference.batch": "A"}
    return (
        spark.createDataFrame(rows, "gene_id string, sample_id string, count bigint"),
        spark.createDataFrame(list(zip(range(8), SAMPLES, CONDITION, BATCH)), "record int, sample_id string, condition string, batch string"),
        spark.createDataFrame([(i, *kv) for i, kv in enumerate(settings.items())], "record int, key string, value string"),
        spark.createDataFrame([(i, *c) for i, c in enumerate(contrasts)], "record int, contrast_id string, factor string, numerator string, denominator string"),
    )


BOTH = [("treated_vs_control", "condition", "treated", "control"), ("control_vs_treated", "condition", "control", "treated")]


def test_local_trend(spark):
    mean = np.exp(np.random.default_rng(3).uniform(0, 8, 3000))
    bent = np.exp(-2 + 0.4 * np.log(mean))
    points = spark.createDataFrame([(float(m), float(d)) for m, d in zip(mean, bent)], "base_mean double, gene_dispersion double")
    trend = fit_local(points)
    inner = np.quantile(mean, np.linspace(0.02, 0.98, 60))
    assert np.abs(np.log(trend(inner)) - (-2 + 0.4 * np.log(inner))).max() < 1e-2
    # A dispersion that grows with the mean has no parametric trend.
    with pytest.warns(UserWarning, match="local instead of parametric"):
        assert not fit_trend(points).parametric
    rest = points.select(residual_column(trend).alias("r")).agg(F.max(F.abs("r"))).first()[0]
    assert rest < 5e-2
    flat = points.select("base_mean", F.lit(0.3).alias("gene_dispersion"))
    assert np.allclose(fit_local(flat)(inner), 0.3, rtol=1e-9)
    single = points.limit(1).select("base_mean", F.lit(0.3).alias("gene_dispersion"))
    assert np.allclose(fit_local(single)(inner), 0.3, rtol=1e-9)


@pytest.mark.parametrize("df,width", [(1, 2.0), (2, 1.0), (3, 4.0)])
def test_prior_width_of_few_residual_degrees(spark, df, width):
    rng = np.random.default_rng(df)
    r = np.log(rng.chisquare(df, 30000) / df) + rng.normal(0, np.sqrt(width), 30000)
    assert matched_width(spark.createDataFrame([(float(v),) for v in r], "r double"), df) == pytest.approx(width, rel=0.2)


@pytest.mark.parametrize("replicates", [3, 7])
def test_outlying_counts(replicates):
    """With seven replicates an outlying count is replaced and the gene refitted; with three its p-value is withheld."""
    n = 2 * replicates
    model = build_model([f"s{i}" for i in range(n)], {"condition": ["a"] * replicates + ["b"] * replicates},
                        {"condition": "categorical"}, ["condition"], {}, "condition", "b", "a")
    rng = np.random.default_rng(11)
    clean = rng.poisson(np.where(np.arange(n) < replicates, 100, 300), (20, n)).astype(float)
    planted = clean.copy()
    planted[4, 1] = 20000
    fitter = GeneFitter(model, np.ones(n), Trend(0.01, 0.1), 1.0, 1.0)

    def fitted(y):
        dispersion, mu = k.genewise_dispersion(y, model.matrix, np.ones(n))
        table = pd.DataFrame({"gene_id": [str(i) for i in range(len(y))], "y": list(y), "mu": list(mu), "gene_dispersion": dispersion})
        return next(fitter(iter([table])))

    before, after = fitted(clean), fitted(planted)
    effect, found = (np.stack(t["beta"])[:, model.coefficient] for t in (before, after))
    others = np.arange(20) != 4
    assert not before["count_outlier"].any() and not before["replaced"].any()
    assert np.allclose(effect[others], found[others]) and abs(effect[4] - np.log(3)) < 0.2
    if replicates == 7:
        assert after["replaced"].tolist() == [i == 4 for i in range(20)] and not after["count_outlier"].any()
        assert abs(found[4] - effect[4]) < 0.2
    else:
        assert after["count_outlier"].tolist() == [i == 4 for i in range(20)] and not after["replaced"].any()
        assert abs(found[4] - effect[4]) > 1


@pytest.fixture(scope="module")
def analysis(spark):
    notes = spark.createDataFrame([(1, "gene_0001", "SHARED", "", "c")], "record int, gene_id string, gene_symbol string, biotype string, chromosome string")
    return run_analysis(*inputs(spark, simulated_counts(), BOTH), notes)


def by_gene(table, contrast):
    return {r["gene_id"]: r for r in table.filter(F.col("contrast_id") == contrast).collect()}


def test_analysis_finds_the_planted_effects(analysis):
    rows = by_gene(analysis.tables["results"], "treated_vs_control")
    assert len(rows) == 999 and f"gene_{EMPTY + 1:04d}" not in rows
    significant = {g for g, r in rows.items() if r["padj"] is not None and r["padj"] < 0.05}
    planted = {f"gene_{i + 1:04d}" for i in (*UP, *DOWN)}
    assert len(significant & planted) > 140 and len(significant - planted) < 30
    assert 1.7 < np.median([rows[f"gene_{i + 1:04d}"]["log2FoldChange"] for i in UP]) < 2.3
    assert -2.3 < np.median([rows[f"gene_{i + 1:04d}"]["log2FoldChange"] for i in DOWN]) < -1.7
    assert any(r["padj"] is None and r["pvalue"] is not None for r in rows.values())
    assert rows["gene_0001"]["gene_symbol"] == "SHARED" and rows["gene_0001"]["biotype"] is None and rows["gene_0002"]["gene_symbol"] is None
    assert analysis.fits[0].trend.parametric and analysis.groups == [0, 1]
    summary = {r["key"]: r["value"] for r in analysis.tables["summary"].filter("contrast_id = 'treated_vs_control'").collect()}
    assert summary["genes_input"] == "1000" and summary["genes_zero_total"] == "1" and summary["significant"] == str(len(significant))
    assert summary["coefficient"] == "condition_treated_vs_control"


def test_reversed_contrast_negates(analysis):
    one, two = (by_gene(analysis.tables["results"], c) for c in ("treated_vs_control", "control_vs_treated"))
    for g, r in one.items():
        assert abs(r["log2FoldChange"] + two[g]["log2FoldChange"]) < 1e-4
        assert (r["padj"] is None) == (two[g]["padj"] is None)


def test_shrunken_volcano_heatmap_and_sample_tables(analysis):
    raw, small = (by_gene(analysis.tables[t], "treated_vs_control") for t in ("results", "shrunken"))
    assert all(small[g]["pvalue"] == raw[g]["pvalue"] and small[g]["padj"] == raw[g]["padj"] for g in raw)
    noise = [f"gene_{i + 1:04d}" for i in SPARSE]
    assert np.median([abs(small[g]["log2FoldChange"]) for g in noise]) < 0.2 * np.median([abs(raw[g]["log2FoldChange"]) for g in noise])
    heat = analysis.tables["heatmap_data"].filter("contrast_id = 'treated_vs_control'").collect()
    order = sorted((r["padj"], g) for g, r in raw.items() if r["padj"] is not None and r["padj"] < 0.05)[:50]
    assert {r["gene_id"] for r in heat} == {g for _, g in order} and len(heat) == 400
    pca = analysis.tables["pca_data"].filter("contrast_id = 'treated_vs_control'").collect()
    assert [r["sample_id"] for r in pca] == SAMPLES and {r["batch"] for r in pca} == {"A", "B"}
    assert analysis.tables["sample_distances"].filter("sample_a = sample_b AND distance > 1e-6").count() == 0
    volcano = by_gene(analysis.tables["volcano_data"], "treated_vs_control")
    assert all(volcano[g]["significant"] == (raw[g]["padj"] is not None and raw[g]["padj"] < 0.05) for g in raw)


def test_published_wide_tables(spark, analysis, tmp_path):
    path = f"{tmp_path}/run"
    analysis.publish(path)
    one = "contrast_id = 'treated_vs_control'"
    for name, value in {"normalized_counts": "value", "heatmap_data": "value"}.items():
        long = {(r["gene_id"], r["sample_id"]): r[value] for r in analysis.tables[name].filter(one).collect()}
        rows, samples = read_matrix(spark, f"{path}/matrices/{name}/contrast_id=treated_vs_control", ["gene_id"])
        found = {(r["gene_id"], s): x for r in rows.collect() for s, x in zip(samples, r["x"])}
        assert samples == SAMPLES and found.keys() == long.keys() and all(found[c] == pytest.approx(long[c], rel=1e-12) for c in long)
    rows, names = read_matrix(spark, f"{path}/matrices/model_matrix/contrast_id=treated_vs_control", ["sample_id"])
    assert names == analysis.fits[0].model.names
    assert {r["sample_id"]: r["x"] for r in rows.collect()} == dict(zip(SAMPLES, analysis.fits[0].model.matrix.tolist()))


def test_bad_matrices_are_refused(spark):
    counts = simulated_counts()[:20]
    matrix, samples, settings, contrasts = inputs(spark, counts, BOTH[:1])
    with pytest.raises(ContractError, match="exactly one count"):
        run_analysis(matrix.filter("NOT (gene_id = 'gene_0003' AND sample_id = 'sample_2')"), samples, settings, contrasts)
    with pytest.raises(ContractError, match="must not exceed"):
        run_analysis(matrix.withColumn("count", F.col("count") + 2147483647), samples, settings, contrasts)
    with pytest.raises(ContractError, match="no genes retained"):
        run_analysis(matrix.withColumn("count", F.lit(0)), samples, settings, contrasts)
