"""From manifests and per-run count files to the gene x sample matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.functions.text import plain_path, resolve_path
from exprspark.operators import checks
from exprspark.operators.counts import merge_runs
from exprspark.session import Workspace
from exprspark.sources.counts import read_run_counts
from exprspark.sources.tsv import read_table

# Columns of the manifests.
RUN_COLUMNS = ["run_id", "sample_id", "fastq_1", "fastq_2", "layout", "strandedness"]
INPUT_COLUMNS = ["run_id", "format", "path", "column"]
ANNOTATION_COLUMNS = ["gene_id", "gene_symbol", "biotype", "chromosome"]
CONTRAST_COLUMNS = ["contrast_id", "factor", "numerator", "denominator"]
REFERENCE_COLUMNS = ["role", "path", "sha256", "source", "release"]
SETTING_COLUMNS = ["key", "value"]


@dataclass
class Merged:
    matrix: DataFrame
    sample_ids: list[str]


def manifest(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A manifest with its record numbers."""
    table = read_table(spark, path, columns)
    named = table.withColumn("record", F.col("_record")).withColumn("manifest", plain_path(F.col("_source")))
    return named.drop("_record", "_source")


def check_runs(samples: DataFrame, runs: DataFrame) -> None:
    checks.enforce(
        checks.union([checks.sample_violations(samples.drop("manifest")), checks.run_violations(samples, runs)])
    )


def merge_counts(
    spark: SparkSession, samples_path: str, runs_path: str, genes_path: str, inputs_path: str, annotation_path: str | None = None
) -> Merged:
    """Check the manifests, read every run's counts, prove completeness and sum technical runs.

    All checks finish before the matrix is handed out; the matrix itself stays lazy and in long form.
    """
    samples, runs = manifest(spark, samples_path), manifest(spark, runs_path, RUN_COLUMNS)
    genes, inputs = manifest(spark, genes_path, ["gene_id"]), manifest(spark, inputs_path, INPUT_COLUMNS)
    if not genes.take(1):
        raise checks.ContractError("gene universe is empty")
    check_runs(samples, runs)
    gates = [
        checks.reserved_violations(samples.select("record", "sample_id")),
        checks.universe_violations(genes),
        checks.input_violations(inputs, runs),
    ]
    if annotation_path:
        gates.append(checks.annotation_violations(manifest(spark, annotation_path, ANNOTATION_COLUMNS), genes))
    checks.enforce(checks.union(gates))
    resolved = inputs.select("run_id", "format", resolve_path(F.col("manifest"), F.col("path")).alias("path"), "column")
    scan = read_run_counts(spark, resolved)
    counts = Workspace(spark, "merge").save(scan.counts, "counts")
    first = scan.problems.orderBy("rule_order", "source", "record").limit(1).collect()
    if first:
        p = first[0]
        raise checks.ContractError(f"{p['source']}: record {p['record']}, column {p['column']}: {p['rule']}")
    report = checks.completeness(counts, runs, genes)
    short = report.filter(~F.col("complete")).orderBy("run_id").limit(1).collect()
    if short:
        r = short[0]
        raise checks.ContractError(
            f"run {r['run_id']}: {r['missing_genes']} genes missing, {r['unknown_genes']} unknown, {r['repeated_genes']} repeated"
        )
    order = [r["sample_id"] for r in samples.orderBy("record").select("sample_id").collect()]
    return Merged(merge_runs(counts, runs), order)


def bundle_violations(
    samples: DataFrame, runs: DataFrame, references: DataFrame, settings: DataFrame, contrasts: DataFrame, files: DataFrame | None = None
) -> DataFrame:
    """All violations of one or many study bundles, in checking order."""
    covariates = checks.covariates_long(samples)
    types = checks.covariate_types(settings)
    stages = [
        checks.sample_violations(samples),
        checks.run_violations(samples, runs),
        checks.reference_violations(references, files),
        checks.setting_violations(settings, covariates),
        checks.covariate_violations(covariates, types),
        checks.design_violations(settings, covariates, types),
        checks.contrast_violations(contrasts, settings, covariates, types),
    ]
    return checks.union([s.withColumn("rule_order", F.col("rule_order") + 100 * (i + 1)) for i, s in enumerate(stages)])


def check_bundle(spark: SparkSession, samples: str, runs: str, references: str, settings: str, contrasts: str) -> DataFrame:
    """Violations of one bundle given by its five files; reference digests are checked against the files."""
    refs = manifest(spark, references, REFERENCE_COLUMNS)
    refs = refs.withColumn("path", F.coalesce(resolve_path(F.col("manifest"), F.col("path")), F.lit(""))).drop("manifest")
    paths = [r["path"] for r in refs.select("path").distinct().collect() if r["path"]]
    known = spark.read.format("binaryFile").option("ignoreMissingFiles", True)
    files = (
        known.load(paths).select(plain_path(F.col("path")).alias("path"), F.sha2("content", 256).alias("sha256"))
        if paths
        else None
    )
    sheet = manifest(spark, samples).drop("manifest")
    return bundle_violations(
        sheet,
        manifest(spark, runs, RUN_COLUMNS).drop("manifest"),
        refs,
        manifest(spark, settings, SETTING_COLUMNS).drop("manifest"),
        manifest(spark, contrasts, CONTRAST_COLUMNS).drop("manifest"),
        files,
    )
