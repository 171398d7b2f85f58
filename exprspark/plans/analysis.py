"""The whole differential-expression analysis: every contrast, each model fitted once."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.functions.text import decimal_value
from exprspark.operators import checks
from exprspark.operators.counts import annotate, pack
from exprspark.session import Workspace
from exprspark.sinks.tables import write_matrix, write_results
from exprspark.stats import results as res
from exprspark.stats import transform as tr
from exprspark.stats.design import Model, build_model, model_groups
from exprspark.stats.fit import Fit, FitError, fit_model
from exprspark.stats.normalize import size_factors


class Matrix(NamedTuple):
    """A wide table by packed rows: ``key``, the array ``x`` in the order of ``names``, and what ``order`` needs."""

    rows: DataFrame
    key: str
    names: list[str]
    order: list[str]


@dataclass
class Analysis:
    """Result tables in long form, one DataFrame per kind, each with a ``contrast_id`` column."""

    tables: dict[str, DataFrame]
    fits: list[Fit]
    groups: list[int]
    sample_ids: list[str]
    matrices: dict[tuple[str, str], Matrix] = field(default_factory=dict)

    def publish(self, path: str) -> None:
        """Long tables by contrast, and each contrast's wide ones under ``matrices``."""
        for name, table in self.tables.items():
            write_results(table, f"{path}/{name}", ["contrast_id"])
        for (name, contrast_id), m in self.matrices.items():
            write_matrix(m.rows, [m.key], "x", m.names, f"{path}/matrices/{name}/contrast_id={contrast_id}", m.order)


@dataclass
class Study:
    """Checked inputs of an analysis; everything here is per sample or per contrast."""

    sample_ids: list[str]
    covariates: dict[str, list]
    types: dict[str, str]
    terms: list[str]
    references: dict[str, str]
    alpha: float
    contrasts: list[dict[str, str]]
    models: list[Model] = field(default_factory=list)


def read_study(samples: DataFrame, settings: DataFrame, contrasts: DataFrame) -> Study:
    """Gate the three tables, then take sample rows, settings and contrasts to the driver.

    One study's tables have a row per sample, setting or contrast and end up on the driver anyway, so each
    is gathered in one partition first; the many small joins of the checks then need no shuffle.
    """
    samples, settings, contrasts = samples.coalesce(1), settings.coalesce(1), contrasts.coalesce(1)
    covariates = checks.covariates_long(samples)
    types = checks.covariate_types(settings)
    checks.enforce(
        checks.union(
            [
                checks.sample_violations(samples),
                checks.reserved_violations(samples),
                checks.setting_violations(settings, covariates),
                checks.covariate_violations(covariates, types),
                checks.design_violations(settings, covariates, types),
                checks.contrast_violations(contrasts, settings, covariates, types),
            ]
        )
    )
    fixed = {r["key"]: r["value"] for r in settings.select("key", "value").collect()}
    type_of = {r["name"]: r["type"] for r in types.select("name", "type").collect()}
    columns = [F.col(f"`{c}`") if type_of.get(c) != "numeric" else decimal_value(F.col(f"`{c}`")).alias(c)
               for c in samples.columns if c not in ("record", "study_id", "manifest")]
    rows = samples.orderBy("record").select(*columns).collect()
    names = [c for c in rows[0].asDict() if c != "sample_id"]
    study = Study(
        sample_ids=[r["sample_id"] for r in rows],
        covariates={c: [r[c] for r in rows] for c in names},
        types=type_of,
        terms=fixed["design_terms"].split(","),
        references={k.split(".", 1)[1]: v for k, v in fixed.items() if k.startswith("reference.")},
        alpha=float(fixed["alpha"]),
        contrasts=[r.asDict() for r in contrasts.orderBy("record").collect()],
    )
    study.models = [
        build_model(study.sample_ids, study.covariates, study.types, study.terms, study.references,
                    c["factor"], c["numerator"], c["denominator"])
        for c in study.contrasts
    ]
    return study


def factor_array(factors: DataFrame, sample_ids: list[str]) -> np.ndarray:
    found = {r["sample_id"]: r["size_factor"] for r in factors.collect()}
    if len(found) < len(sample_ids):
        raise FitError("every gene contains at least one zero, cannot compute log geometric means")
    return np.array([found[s] for s in sample_ids])


def model_matrix_table(spark: SparkSession, model: Model) -> DataFrame:
    rows = [(s, *map(float, model.matrix[i])) for i, s in enumerate(model.samples)]
    schema = ", ".join(["sample_id string"] + [f"`{n}` double" for n in model.names])
    return spark.createDataFrame(rows, schema)


def sample_tables(spark: SparkSession, arrays: DataFrame, model: Model, covariates: dict[str, list]) -> dict[str, DataFrame]:
    """PCA scores and sample distances from the packed, stabilized rows, a written table."""
    scores, share = tr.principal_components(arrays, len(model.samples))
    names = list(covariates)
    rows = [
        (s, float(scores[i, 0]), float(scores[i, 1]), float(share[0]), float(share[1]), *[covariates[n][i] for n in names])
        for i, s in enumerate(model.samples)
    ]
    kinds = ["double" if isinstance(covariates[n][0], float) else "string" for n in names]
    schema = "sample_id string, PC1 double, PC2 double, PC1_variance double, PC2_variance double"
    schema += "".join(f", `{n}` {t}" for n, t in zip(names, kinds))
    order = spark.createDataFrame(list(enumerate(model.samples)), "at int, sample_id string")
    return {"pca_data": spark.createDataFrame(rows, schema), "sample_distances": tr.sample_distances(arrays, order)}


def contrast_tables(ws: Workspace, study: Study, fit: Fit, i: int, facts: dict[str, str], annotation: DataFrame | None, arrays: DataFrame) -> dict[str, DataFrame]:
    contrast, model = study.contrasts[i], study.models[i]
    name = f"contrast{i}"
    raw = ws.save(res.independent_filter(res.wald(fit, model.coefficient), study.alpha), f"{name}-results")
    shrunk = ws.save(res.shrink(fit, raw, model.coefficient), f"{name}-shrunken")
    facts = {
        "contrast_id": contrast["contrast_id"], "factor": contrast["factor"], "numerator": contrast["numerator"],
        "denominator": contrast["denominator"], "coefficient": model.coefficient_name, "alpha": repr(study.alpha), **facts,
    }

    def named(table: DataFrame) -> DataFrame:
        return annotate(table, annotation) if annotation is not None else table

    vst = tr.unpack(arrays, model.samples)
    return {
        "results": named(raw),
        "shrunken": named(shrunk),
        "summary": res.contrast_summary(raw, facts, study.alpha),
        "volcano_data": res.volcano(raw, shrunk, study.alpha),
        "heatmap_data": res.heatmap(raw, vst, study.alpha),
        "ma_raw": res.ma_data(raw, study.alpha),
        "ma_shrunken": res.ma_data(shrunk, study.alpha),
    }


def model_tables(spark: SparkSession, study: Study, fit: Fit, arrays: DataFrame) -> dict[str, DataFrame]:
    """Tables that depend on the model only; contrasts of one model share them."""
    normalized = tr.unpack(tr.normalized_arrays(fit.genes, fit.size_factors), fit.model.samples)
    return {
        "normalized_counts": normalized,
        "model_matrix": model_matrix_table(spark, fit.model).unpivot("sample_id", None, "coefficient", "value"),
        "dispersion_data": res.dispersion_data(fit),
        **sample_tables(spark, arrays, fit.model, study.covariates),
    }


def contrast_matrices(spark: SparkSession, fit: Fit, arrays: DataFrame, results: DataFrame, alpha: float) -> dict[str, Matrix]:
    """The wide tables of one contrast, from packed rows: genes in byte order, the heatmap's by rank."""
    samples, design = fit.model.samples, model_matrix_table(spark, fit.model)
    coefficients = [F.col(f"`{n}`") for n in fit.model.names]
    return {
        "normalized_counts": Matrix(tr.normalized_arrays(fit.genes, fit.size_factors), "gene_id", samples, ["gene_id"]),
        "vst_counts": Matrix(arrays, "gene_id", samples, ["gene_id"]),
        "heatmap_data": Matrix(res.heatmap(results, arrays, alpha), "gene_id", samples, ["rank"]),
        "model_matrix": Matrix(design.coalesce(1).select("sample_id", F.array(*coefficients).alias("x")), "sample_id", fit.model.names, []),
    }


def run_analysis(
    matrix: DataFrame, samples: DataFrame, settings: DataFrame, contrasts: DataFrame, annotation: DataFrame | None = None
) -> Analysis:
    """Differential expression of ``matrix(gene_id, sample_id, count)`` for all contrasts.

    ``samples(record, sample_id, condition, ...)``, ``settings(record, key, value)``,
    ``contrasts(record, contrast_id, factor, numerator, denominator)``. All input and model checks end
    before the first fit.
    """
    spark = matrix.sparkSession
    study = read_study(samples, settings, contrasts)
    ws = Workspace(spark, "analysis")
    ordinals = samples.select("sample_id", F.col("record").alias("ordinal"))
    packed_all = ws.save(pack(matrix, ordinals), "packed")
    n = len(study.sample_ids)
    has_count = F.exists("y", lambda v: v > 0)
    tally = packed_all.agg(
        F.count(F.lit(1)).alias("genes"),
        F.count_if(~has_count).alias("empty"),
        F.count_if(F.size("y") != n).alias("ragged"),
        F.count_if(F.array_max("y") > checks.INT32_MAX).alias("large"),
        F.sum("strangers").alias("strangers"),
    ).first()
    if tally["ragged"] or tally["strangers"]:
        raise checks.ContractError("every gene needs exactly one count per listed sample")
    if tally["large"]:
        raise checks.ContractError(f"counts must not exceed {checks.INT32_MAX}")
    if annotation is not None:
        checks.enforce(checks.annotation_violations(annotation, packed_all.select("gene_id")))
    retained = tally["genes"] - tally["empty"]
    if not retained:
        raise checks.ContractError("no genes retained after zero_total filtering")
    packed = packed_all.filter(has_count)
    sf = factor_array(size_factors(packed, study.sample_ids), study.sample_ids)
    facts = {"genes_input": str(tally["genes"]), "genes_zero_total": str(tally["empty"])}
    groups = model_groups(study.models)
    fits: list[Fit] = []
    collected: dict[str, list[DataFrame]] = {}
    matrices: dict[tuple[str, str], Matrix] = {}
    shared: dict[int, tuple[DataFrame, dict[str, DataFrame]]] = {}
    for i, group in enumerate(groups):
        if group not in shared:
            fit = fit_model(ws, packed, study.models[i], sf, f"model{group}", retained)
            fits.append(fit)
            arrays = ws.save(tr.vst_arrays(fit), f"model{group}-vst")
            shared[group] = (arrays, model_tables(spark, study, fit, arrays))
        arrays, per_model = shared[group]
        tables = contrast_tables(ws, study, fits[group], i, facts, annotation, arrays) | per_model
        for name, table in tables.items():
            tagged = table.withColumn("contrast_id", F.lit(study.contrasts[i]["contrast_id"]))
            collected.setdefault(name, []).append(tagged)
        for name, matrix_ in contrast_matrices(spark, fits[group], arrays, tables["results"], study.alpha).items():
            matrices[name, study.contrasts[i]["contrast_id"]] = matrix_
    united = {n: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) for n, parts in collected.items()}
    return Analysis(united, fits, groups, study.sample_ids, matrices)
