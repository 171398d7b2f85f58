"""Constraint checks over manifests and matrices. Each returns violation rows; none stops at the first.

Frames may carry ``study_id`` so that one job checks a whole catalog of studies; a frame without it is one
study. ``record`` orders the rows of a frame within its study. Violations have the columns
``study_id, record, column, rule, rule_order``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exprspark.operators.ordering import ordered_counts
from exprspark.session import Workspace
from exprspark.functions.text import (
    INT32_MAX,
    decimal_value,
    lower_hex,
    split_terms,
    uint64_value,
    valid_digest,
    valid_id,
    valid_identifier,
)

# Enumerations, required settings and reserved names of the input contract.
LAYOUTS = ("single", "paired")
STRANDS = ("unstranded", "forward", "reverse")
ROLES = ("genome", "annotation")
FORMATS = ("tsv", "legacy", "featurecounts")
TYPES = ("categorical", "numeric")
REQUIRED_SETTINGS = ("version", "design_terms", "alpha", "filter", "shrinkage")
FIXED_SETTINGS = {"version": "1", "filter": "zero_total", "shrinkage": "apeglm"}
RESERVED_SAMPLES = ("gene_id", "sample_id")
RESERVED_COVARIATES = ("PC1", "PC2", "PC1_variance", "PC2_variance")

VIOLATION = ["study_id", "record", "column", "rule", "rule_order"]


def keyed(df: DataFrame) -> DataFrame:
    return df if "study_id" in df.columns else df.withColumn("study_id", F.lit("study"))


def broken_rules(df: DataFrame, rules: list[tuple[Column, str, str]], start: int = 0) -> DataFrame:
    """Row rules ``(broken, column, rule)`` tested in one pass; a row gives one violation per broken rule."""
    tests = [
        F.when(
            F.coalesce(broken, F.lit(True)),
            F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule"), F.lit(start + i).alias("rule_order")),
        )
        for i, (broken, column, rule) in enumerate(rules)
    ]
    found = df.select("study_id", "record", F.explode(F.filter(F.array(*tests), lambda t: t.isNotNull())).alias("v"))
    return found.select("study_id", "record", "v.column", "v.rule", "v.rule_order")


def rows_as(df: DataFrame, column: str | Column, rule: str | Column, order: int) -> DataFrame:
    name = F.lit(column) if isinstance(column, str) else column
    rule = F.lit(rule) if isinstance(rule, str) else rule
    record = F.col("record") if "record" in df.columns else F.lit(1)
    return df.select(
        "study_id", record.cast("bigint").alias("record"), name.alias("column"), rule.alias("rule"), F.lit(order).alias("rule_order")
    )


def union(frames: list[DataFrame]) -> DataFrame:
    typed = [f.withColumn("record", F.col("record").cast("bigint")).select(*VIOLATION) for f in frames]
    return reduce(DataFrame.unionByName, typed)


def repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Second and later rows of each key.

    The first record per key is a partial aggregate joined back, so a key that holds a third of all rows
    is never sorted in one task as a window over it would be.
    """
    at = ["study_id", *keys]
    first = df.groupBy(*at).agg(F.min("record").alias("first_record"))
    return df.join(first, at).filter(F.col("record") > F.col("first_record"))


def absent(studies: DataFrame, present: DataFrame) -> DataFrame:
    return studies.select("study_id").distinct().join(present.select("study_id").distinct(), "study_id", "left_anti")


def absent_values(studies: DataFrame, present: DataFrame, column: str, wanted: tuple[str, ...]) -> DataFrame:
    """Wanted values no row of a study holds, as ``(study_id, wanted, position)``."""
    listed = F.array(*[F.lit(w) for w in wanted])
    asked = studies.select("study_id").distinct().select("study_id", F.posexplode(listed).alias("position", "wanted"))
    held = present.select("study_id", F.col(column).alias("wanted")).distinct()
    return asked.join(held, ["study_id", "wanted"], "left_anti")


def sample_violations(samples: DataFrame, studies: DataFrame | None = None) -> DataFrame:
    samples = keyed(samples)
    found = [
        broken_rules(
            samples,
            [
                (~valid_id(F.col("sample_id")), "sample_id", "invalid_id"),
                (F.col("condition") == "", "condition", "empty_cell"),
            ],
        ),
        rows_as(repeats(samples, ["sample_id"]), "sample_id", "repeated_id", 2),
    ]
    if studies is not None:
        found.append(rows_as(absent(studies, samples), "sample_id", "no_samples", -1))
    return union(found)


def run_violations(samples: DataFrame, runs: DataFrame) -> DataFrame:
    """Run manifest against its samples: ids, both foreign keys, enums and one library type per sample."""
    samples, runs = keyed(samples), keyed(runs)
    at = ["study_id", "sample_id"]
    library = F.struct("record", "layout", "strandedness")
    first = runs.groupBy(*at).agg(F.min(library).alias("first"))
    with_first = runs.join(first, at)
    paired = F.col("layout") == "paired"
    return union(
        [
            broken_rules(
                runs,
                [
                    (~valid_id(F.col("run_id")), "run_id", "invalid_id"),
                    (~F.col("layout").isin(*LAYOUTS), "layout", "not_allowed"),
                    (~F.col("strandedness").isin(*STRANDS), "strandedness", "not_allowed"),
                    (F.col("fastq_1") == "", "fastq_1", "empty_path"),
                    ((F.col("layout") == "single") & (F.col("fastq_2") != ""), "fastq_2", "second_file_of_single"),
                    (paired & (F.col("fastq_2") == ""), "fastq_2", "empty_path"),
                    (paired & (F.col("fastq_2") != "") & (F.col("fastq_1") == F.col("fastq_2")), "fastq_2", "same_file_twice"),
                ],
                10,
            ),
            rows_as(repeats(runs, ["run_id"]), "run_id", "repeated_id", 20),
            rows_as(runs.join(samples.select(*at).distinct(), at, "left_anti"), "sample_id", "unknown_sample", 21),
            rows_as(samples.join(runs.select(*at).distinct(), at, "left_anti"), "sample_id", "sample_without_run", 40),
            rows_as(with_first.filter(F.col("layout") != F.col("first.layout")), "layout", "mixed_layout", 30),
            rows_as(with_first.filter(F.col("strandedness") != F.col("first.strandedness")), "strandedness", "mixed_strandedness", 31),
            rows_as(absent(samples, runs), "run_id", "no_runs", -1),
        ]
    )


def reference_violations(references: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Both roles once, described, with a sound digest that matches the file inventory when one is given."""
    references = keyed(references)
    studies = references.select("study_id").distinct()
    found = [
        broken_rules(
            references,
            [
                (~F.col("role").isin(*ROLES), "role", "not_allowed"),
                (F.col("source") == "", "source", "empty_cell"),
                (F.col("release") == "", "release", "empty_cell"),
                (~valid_digest(F.col("sha256")), "sha256", "not_a_digest"),
                (F.col("path") == "", "path", "empty_path"),
            ],
        ),
        rows_as(repeats(references, ["role"]), "role", "repeated_role", 10),
    ]
    missing = absent_values(studies, references, "role", ROLES)
    found.append(rows_as(missing, "role", F.concat(F.lit("missing_"), "wanted"), 20))
    if files is not None:
        actual = files.select("path", F.col("sha256").alias("actual"))
        checked = references.join(actual, "path", "left")
        found.append(rows_as(checked.filter(F.col("actual").isNull()), "path", "missing_file", 11))
        found.append(rows_as(checked.filter(F.col("actual") != lower_hex(F.col("sha256"))), "sha256", "digest_differs", 12))
    return union(found)


def covariates_long(samples: DataFrame) -> DataFrame:
    """Sample covariates as ``(study_id, record, sample_id, name, value)``."""
    samples = keyed(samples)
    fixed = ["study_id", "record", "sample_id"]
    names = [c for c in samples.columns if c not in fixed and not c.startswith("_")]
    return samples.unpivot([F.col(c) for c in fixed], [F.col(f"`{c}`") for c in names], "name", "value")


def declared(settings: DataFrame, prefix: str) -> DataFrame:
    key = F.col("key")
    return settings.filter(key.startswith(prefix)).select(
        "study_id", "record", F.substring(key, F.lit(len(prefix) + 1), F.length(key)).alias("name"), F.col("value").alias("declared")
    )


def covariate_types(settings: DataFrame) -> DataFrame:
    """Type per covariate and study; ``condition`` is categorical without a declaration."""
    settings = keyed(settings)
    implied = settings.select("study_id", F.lit("condition").alias("name"), F.lit("categorical").alias("type")).distinct()
    named = declared(settings, "type.").select("study_id", "name", F.col("declared").alias("type"))
    return implied.unionByName(named.filter(F.col("name") != "condition")).distinct()


def setting_violations(settings: DataFrame, covariates: DataFrame) -> DataFrame:
    """Keys, fixed values, alpha, and ``type.*`` / ``reference.*`` declarations against the covariates."""
    settings = keyed(settings)
    key, value = F.col("key"), F.col("value")
    known = key.isin(*REQUIRED_SETTINGS) | key.startswith("type.") | key.startswith("reference.")
    alpha = decimal_value(value)
    rules = [
        (key == "", "key", "empty_key"),
        ((key != "") & ~known, "key", "unknown_setting"),
        ((key == "alpha") & ~F.coalesce((alpha > 0) & (alpha < 1), F.lit(False)), "value", "alpha_out_of_range"),
        (key.startswith("type.") & ~value.isin(*TYPES), "value", "not_a_type"),
        ((key == "type.condition") & (value == "numeric"), "value", "condition_not_categorical"),
    ]
    rules += [((key == k) & (value != v), "value", f"{k}_must_be_{v}") for k, v in FIXED_SETTINGS.items()]
    found = [broken_rules(settings, rules), rows_as(repeats(settings, ["key"]), "key", "repeated_key", 20)]
    missing = absent_values(settings, settings, "key", REQUIRED_SETTINGS)
    found.append(rows_as(missing, F.col("wanted"), "missing_setting", 30))
    names = covariates.select("study_id", "name").distinct()
    marked = settings.filter(key.startswith("type.") | key.startswith("reference.")).select(
        "study_id", "record", F.regexp_extract(key, r"\A(?:type|reference)\.(.*)\z", 1).alias("name")
    )
    found.append(rows_as(marked.join(names, ["study_id", "name"], "left_anti"), "key", "names_absent_covariate", 40))
    return union(found)


def covariate_violations(covariates: DataFrame, types: DataFrame) -> DataFrame:
    """Every covariate typed; categorical cells non-empty; numeric cells finite decimals."""
    joined = covariates.join(types, ["study_id", "name"], "left")
    untyped = joined.filter(F.col("type").isNull()).select("study_id", F.lit(1).alias("record"), "name").distinct()
    empty = joined.filter((F.col("type") == "categorical") & (F.col("value") == ""))
    odd = joined.filter((F.col("type") == "numeric") & decimal_value(F.col("value")).isNull())
    return union(
        [
            rows_as(untyped, F.col("name"), "untyped_covariate", 0),
            rows_as(empty, F.col("name"), "empty_category", 1),
            rows_as(odd, F.col("name"), "not_a_finite_decimal", 2),
        ]
    )


def design_terms(settings: DataFrame) -> DataFrame:
    settings = keyed(settings).filter(F.col("key") == "design_terms")
    return settings.select("study_id", "record", F.posexplode(split_terms(F.col("value"))).alias("position", "term"))


def design_violations(settings: DataFrame, covariates: DataFrame, types: DataFrame) -> DataFrame:
    """Design terms are unique covariates; references are observed levels of categorical covariates."""
    settings = keyed(settings)
    terms = design_terms(settings)
    names = covariates.select("study_id", F.col("name").alias("term")).distinct()
    twice = terms.groupBy("study_id", "term").agg(F.count(F.lit(1)).alias("n"), F.min("record").alias("record")).filter("n > 1")
    refs = declared(settings, "reference.")
    typed = refs.join(types, ["study_id", "name"], "left")
    levels = covariates.select("study_id", "name", F.col("value").alias("declared")).distinct()
    return union(
        [
            rows_as(terms.filter(~valid_identifier(F.col("term"))), "value", "invalid_term", 0),
            rows_as(twice, "value", "repeated_term", 1),
            rows_as(terms.join(names, ["study_id", "term"], "left_anti"), "value", "absent_term", 2),
            rows_as(typed.filter(F.coalesce(F.col("type") != "categorical", F.lit(True))), "key", "reference_not_categorical", 3),
            rows_as(refs.join(levels, ["study_id", "name", "declared"], "left_anti"), "value", "reference_not_observed", 4),
        ]
    )


def contrast_violations(contrasts: DataFrame, settings: DataFrame, covariates: DataFrame, types: DataFrame) -> DataFrame:
    contrasts, settings = keyed(contrasts), keyed(settings)
    terms = design_terms(settings).select("study_id", F.col("term").alias("factor")).distinct()
    categorical = types.filter(F.col("type") == "categorical").select("study_id", F.col("name").alias("factor"))
    levels = covariates.select("study_id", F.col("name").alias("factor"), F.col("value").alias("level")).distinct()
    refs = declared(settings, "reference.").select("study_id", F.col("name").alias("factor"), F.col("declared").alias("reference"))

    sides = F.array(*[F.struct(F.lit(c).alias("side"), F.col(c).alias("level")) for c in ("numerator", "denominator")])
    asked = contrasts.select("study_id", "record", "factor", F.inline(sides)).filter("level <> ''")
    unobserved = asked.join(levels, ["study_id", "factor", "level"], "left_anti")

    wanted = design_terms(settings).select("study_id", "record", F.col("term").alias("factor"))
    anchored = refs.select("study_id", "factor").unionByName(contrasts.select("study_id", "factor")).distinct()
    loose = wanted.join(categorical, ["study_id", "factor"], "left_semi").join(anchored, ["study_id", "factor"], "left_anti")
    against = contrasts.join(refs, ["study_id", "factor"]).filter(F.col("reference") != F.col("denominator"))
    return union(
        [
            broken_rules(
                contrasts,
                [
                    (~valid_id(F.col("contrast_id")), "contrast_id", "invalid_id"),
                    (F.col("numerator") == "", "numerator", "empty_cell"),
                    (F.col("denominator") == "", "denominator", "empty_cell"),
                    (F.col("numerator") == F.col("denominator"), "numerator", "same_level_twice"),
                ],
            ),
            rows_as(repeats(contrasts, ["contrast_id"]), "contrast_id", "repeated_id", 10),
            rows_as(contrasts.join(terms, ["study_id", "factor"], "left_anti"), "factor", "not_a_design_term", 11),
            rows_as(contrasts.join(categorical, ["study_id", "factor"], "left_anti"), "factor", "not_categorical", 12),
            rows_as(unobserved, F.col("side"), "level_not_observed", 13),
            rows_as(against, "denominator", "disagrees_with_reference", 15),
            rows_as(loose, "value", "term_without_reference", 20),
            rows_as(absent(settings, contrasts), "contrast_id", "no_contrasts", -1),
        ]
    )


def matrix_violations(long: DataFrame) -> DataFrame:
    """Long text cells ``(record, gene_id, sample_id, count)`` of a wide matrix."""
    long = keyed(long)
    genes = long.select("study_id", "record", "gene_id").distinct()
    ids = long.select("study_id", "sample_id").distinct().filter(~valid_id(F.col("sample_id")))
    bad = long.filter(uint64_value(F.col("count")).isNull())
    return union(
        [
            rows_as(ids, F.col("sample_id"), "invalid_id", 0),
            rows_as(genes.filter(F.col("gene_id") == ""), "gene_id", "empty_gene", 1),
            rows_as(repeats(genes, ["gene_id"]), "gene_id", "repeated_gene", 2),
            rows_as(bad, F.col("sample_id"), "not_a_count", 3),
        ]
    )


def int32_violations(long: DataFrame) -> DataFrame:
    long = keyed(long)
    return rows_as(long.filter(F.col("count") > INT32_MAX), F.col("sample_id"), "beyond_int32", 0)


def column_order_violations(columns: DataFrame, samples: DataFrame) -> DataFrame:
    """Count columns ``(ordinal, sample_id)`` must list the samples in manifest order, no more and no less."""
    columns, samples = keyed(columns), keyed(samples)
    have = columns.select("study_id", "ordinal", F.col("sample_id").alias("have"))
    want = samples.select("study_id", "ordinal", F.col("sample_id").alias("want"))
    both = have.join(want, ["study_id", "ordinal"], "full_outer")
    wrong = both.filter(~F.col("have").eqNullSafe(F.col("want")))
    return rows_as(
        wrong.withColumn("record", F.col("ordinal")), F.coalesce("have", "want"), "column_order", 0
    )


def annotation_violations(annotation: DataFrame, universe: DataFrame) -> DataFrame:
    annotation, universe = keyed(annotation), keyed(universe)
    at = ["study_id", "gene_id"]
    return union(
        [
            rows_as(annotation.filter(F.col("gene_id") == ""), "gene_id", "empty_gene", 0),
            rows_as(annotation.join(universe.select(*at), at, "left_anti"), "gene_id", "unknown_gene", 1),
            rows_as(repeats(annotation, ["gene_id"]), "gene_id", "repeated_gene", 2),
        ]
    )


def universe_violations(universe: DataFrame) -> DataFrame:
    universe = keyed(universe)
    return union(
        [
            rows_as(universe.filter(F.col("gene_id") == ""), "gene_id", "empty_gene", 0),
            rows_as(repeats(universe, ["gene_id"]), "gene_id", "repeated_gene", 1),
        ]
    )


def input_violations(inputs: DataFrame, runs: DataFrame) -> DataFrame:
    """Each run has one count input, each input a run; only table inputs name a column."""
    inputs, runs = keyed(inputs), keyed(runs)
    at = ["study_id", "run_id"]
    table = F.col("format") == "featurecounts"
    return union(
        [
            broken_rules(
                inputs,
                [
                    (~F.col("format").isin(*FORMATS), "format", "not_allowed"),
                    (table & (F.col("column") == ""), "column", "empty_cell"),
                    (~table & (F.col("column") != ""), "column", "column_not_expected"),
                    (F.col("path") == "", "path", "empty_path"),
                ],
            ),
            rows_as(inputs.join(runs.select(*at).distinct(), at, "left_anti"), "run_id", "unknown_run", 10),
            rows_as(repeats(inputs, ["run_id"]), "run_id", "repeated_run", 11),
            rows_as(runs.join(inputs.select(*at).distinct(), at, "left_anti").withColumn("record", F.lit(1)), F.col("run_id"), "run_without_input", 12),
        ]
    )


def completeness(counts: DataFrame, runs: DataFrame, universe: DataFrame) -> DataFrame:
    """Per run ``(run_id, genes_seen, unknown_genes, repeated_genes, missing_genes, complete)``.

    Counting is enough to prove completeness: a run whose distinct known genes number as many as the
    universe misses none. No gene x run grid is built.
    """
    known = universe.select("gene_id", F.lit(True).alias("known"))
    per_gene = counts.groupBy("run_id", "gene_id").agg(F.count(F.lit(1)).alias("rows"))
    tagged = per_gene.join(known, "gene_id", "left")
    per_run = tagged.groupBy("run_id").agg(
        F.count_if("known").alias("genes_seen"),
        F.count_if(F.col("known").isNull()).alias("unknown_genes"),
        F.sum(F.col("rows") - 1).alias("repeated_genes"),
    )
    size = universe.agg(F.count(F.lit(1)).alias("universe")).scalar()
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("genes_seen", "unknown_genes", "repeated_genes")}
    whole = runs.select("run_id").join(per_run, "run_id", "left").withColumns(zero).withColumn("universe", size)
    return whole.withColumn("missing_genes", F.col("universe") - F.col("genes_seen")).select(
        "run_id",
        "genes_seen",
        "unknown_genes",
        "repeated_genes",
        "missing_genes",
        ((F.col("missing_genes") == 0) & (F.col("unknown_genes") == 0) & (F.col("repeated_genes") == 0)).alias("complete"),
    )


def missing_genes(counts: DataFrame, report: DataFrame, universe: DataFrame) -> DataFrame:
    """``(run_id, gene_id)`` still missing, for the incomplete runs only.

    Genes are numbered; between two numbers a run has in succession lie exactly the genes it misses. So only true gaps
    are ever emitted, and a run's numbers are ordered within that run alone.
    """
    space = Workspace(counts.sparkSession, "missing")
    numbers = ordered_counts(universe.select("gene_id").distinct(), "gene_id", []).select("gene_id", F.col("upto").alias("number"))
    numbers = space.save(numbers, "numbers")
    short = report.filter("missing_genes > 0").select("run_id")
    last = numbers.agg(F.count(F.lit(1)).alias("last")).scalar()
    seen = counts.join(short, "run_id", "left_semi").select("run_id", "gene_id").distinct().join(numbers, "gene_id")
    # A run that saw nothing still has its two ends.
    ends = short.select("run_id", F.explode(F.array(F.lit(0).cast("long"), last + 1)).alias("number"))
    places = seen.select("run_id", "number").unionByName(ends)
    before = F.lag("number").over(Window.partitionBy("run_id").orderBy("number"))
    gaps = places.withColumn("before", before).filter(F.col("number") - F.col("before") > 1)
    gaps = gaps.select("run_id", F.explode(F.sequence(F.col("before") + 1, F.col("number") - 1)).alias("number"))
    return gaps.join(numbers, "number").select("run_id", "gene_id")


def reserved_violations(samples: DataFrame) -> DataFrame:
    samples = keyed(samples)
    names = [c for c in samples.columns if c in RESERVED_COVARIATES]
    found = [rows_as(samples.filter(F.col("sample_id").isin(*RESERVED_SAMPLES)), "sample_id", "reserved_id", 0)]
    for name in names:
        found.append(rows_as(samples.select("study_id", F.lit(1).alias("record")).distinct(), name, "reserved_covariate", 1))
    return union(found)


def cohort_violations(samples: DataFrame, runs: DataFrame, expected: dict[str, str], size: int) -> DataFrame:
    """Study size, one-to-one experiments and the run columns that must hold one value each."""
    samples, runs = keyed(samples), keyed(runs)
    at = ["study_id", "experiment"]
    runs = runs.withColumnRenamed("experiment_accession", "experiment")
    counted = samples.groupBy("study_id").agg(F.count(F.lit(1)).alias("n"), F.max("record").alias("record"))
    found = [
        rows_as(counted.filter(F.col("n") != size), "sample_id", "cohort_size", 0),
        rows_as(repeats(runs, ["experiment"]), "experiment", "repeated_experiment", 1),
        rows_as(samples.join(runs.select(*at).distinct(), at, "left_anti"), "experiment", "sample_without_run", 2),
        rows_as(runs.join(samples.select(*at).distinct(), at, "left_anti"), "experiment", "run_without_sample", 3),
    ]
    for i, (column, value) in enumerate(expected.items()):
        found.append(rows_as(runs.filter(F.col(column) != value), column, "unexpected_value", 10 + i))
    return union(found)


def cohort_matrix_violations(cells: DataFrame, samples: DataFrame, conditions: tuple[str, ...]) -> DataFrame:
    """A cohort's matrix against its samples: the same count columns, genes once, raw 32-bit counts, and every condition.

    ``cells(record, gene_id, count_column, count)`` hold text counts, ``samples(count_column, condition)`` the cohort.
    """
    cells, samples = keyed(cells), keyed(samples)
    at = ["study_id", "count_column"]
    have, want = cells.select(*at).distinct(), samples.select(*at).distinct()
    value = uint64_value(F.col("count"))
    return union(
        [
            rows_as(have.join(want, at, "left_anti"), F.col("count_column"), "unknown_count_column", 0),
            rows_as(want.join(have, at, "left_anti"), F.col("count_column"), "missing_count_column", 1),
            rows_as(repeats(cells.select("study_id", "record", "gene_id").distinct(), ["gene_id"]), "gene_id", "repeated_gene", 2),
            rows_as(cells.filter(value.isNull()), F.col("count_column"), "not_a_count", 3),
            rows_as(cells.filter(value > INT32_MAX), F.col("count_column"), "beyond_int32", 4),
            rows_as(absent_values(samples, samples, "condition", conditions), F.col("wanted"), "missing_condition", 5),
        ]
    )


# Fixed value: how a provenance document names a contiguous prefix.
PREFIX_SAMPLING = "first N complete FASTQ records in archive order;"


def read_stage_violations(reads: DataFrame) -> DataFrame:
    """Provenance reads must come from contiguous prefixes: the stated sampling, and no own selection."""
    selection = F.col("read.selection") if "selection" in reads.schema["read"].dataType.names else F.lit(None)
    rows = reads.select(F.lit("study").alias("study_id"), F.col("read.run_id").alias("run_id"), "sampling", selection.alias("selection"))
    return union(
        [
            rows_as(rows.filter(~F.coalesce(F.col("sampling").startswith(PREFIX_SAMPLING), F.lit(False))), F.col("run_id"), "not_a_prefix_stage", 0),
            rows_as(rows.filter(F.col("selection").isNotNull()), F.col("run_id"), "non_prefix_selection", 1),
        ]
    )


class ContractError(ValueError):
    """Raised for the first violation of a gated input."""


def enforce(violations: DataFrame) -> None:
    """Fail on the first violation by rule order, record and column; one row reaches the driver."""
    first = violations.orderBy("rule_order", "record", "column").limit(1).collect()
    if first:
        v = first[0]
        raise ContractError(f"record {v['record']}, column {v['column']}: {v['rule']}")
