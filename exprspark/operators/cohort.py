"""Study staging: sample to run mapping, cohorts, set operations on id columns and cohort summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.operators.compare import pairs_of


def sample_run_mapping(samples: DataFrame, runs: DataFrame, strandedness: str) -> DataFrame:
    """Samples joined to their sequencing run through the experiment accession; a sample without a run fails the job."""
    carried = [c for c in ("fastq_ftp", "fastq_md5", "fastq_bytes", "read_count") if c in runs.columns]
    joined = samples.join(runs.withColumnRenamed("experiment_accession", "experiment"), "experiment", "left")
    told = F.raise_error(F.concat(F.lit("sample without a run: "), F.coalesce("sample_id", F.lit("NULL"))))
    return joined.select(
        "sample_id",
        "title",
        "count_column",
        F.col("experiment").alias("experiment_id"),
        F.coalesce("run_accession", told).alias("run_id"),
        F.lower("library_layout").alias("layout"),
        F.lit(strandedness).alias("strandedness"),
        *carried,
    )


def lookup_in_order(samples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mapping rows for the listed samples; ``ordinal`` keeps the list's order."""
    return samples.select("ordinal", "sample_id").join(mapping, "sample_id", "left")


def cohort_members(samples: DataFrame, left_out: DataFrame, listed: DataFrame) -> DataFrame:
    """Three cohorts over one sample list as ``(cohort, sample_id)``: all, all but some, a given list."""
    ids = samples.select("sample_id")

    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("cohort"), "sample_id")

    return (
        named(ids, "full")
        .unionByName(named(ids.join(left_out, "sample_id", "left_anti"), "without"))
        .unionByName(named(ids.join(listed, "sample_id", "left_semi"), "subset"))
    )


def cohort_counts(matrix: DataFrame, members: DataFrame) -> DataFrame:
    """Matrix cells of every cohort as ``(cohort, gene_id, sample_id, count)``, to be written by cohort."""
    return members.join(matrix, "sample_id")


# Cells that one task sums; it holds at most so many, whatever the size of the matrix.
CELLS_PER_TASK = 500_000


def cohort_totals(items: DataFrame, members: DataFrame) -> DataFrame:
    """Per cohort and gene ``(cohort, gene_id, samples, count)`` of ``items(gene_id, sample_id, count)``, which may repeat cells.

    Items are dealt once, by gene, to as many tasks as their number asks for, so cells and totals are both summed where
    they lie and the memory of a task doesn't grow with the matrix.
    """
    tasks = -(-items.count() // CELLS_PER_TASK) or 1
    cells = items.repartition(tasks, "gene_id").groupBy("gene_id", "sample_id").agg(F.sum("count").alias("count"))
    return cohort_counts(cells, members).groupBy("gene_id", "cohort").agg(F.count(F.lit(1)).alias("samples"), F.sum("count").alias("count"))


def same_set(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """One row ``(only_left, only_right, equal)`` for two sets of rows, counted in a single shuffle."""
    left = a.select(*columns).withColumn("side", F.lit(1))
    right = b.select(*columns).withColumn("side", F.lit(2))
    sides = left.unionByName(right).groupBy(*columns).agg(F.bit_or("side").alias("sides"))
    tally = sides.agg(
        F.count_if(F.col("sides") == 1).alias("only_left"), F.count_if(F.col("sides") == 2).alias("only_right")
    )
    return tally.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def same_sets(table: DataFrame, names: list[str], columns: list[str], by: str = "backend") -> DataFrame:
    """``same_set`` of every two of the named parts of a table, as ``by_a, by_b, only_left, only_right, equal``."""
    sides = pairs_of(table, names, columns, {"held": F.lit(True)}, by)
    tally = sides.groupBy(f"{by}_a", f"{by}_b").agg(
        F.count_if(F.col("held_a").isNotNull() & F.col("held_b").isNull()).alias("only_left"),
        F.count_if(F.col("held_b").isNotNull() & F.col("held_a").isNull()).alias("only_right"),
    )
    return tally.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def novel_and_absent(current: DataFrame, past: DataFrame) -> DataFrame:
    """Genes only in the current list (novel) or only in the past one (absent)."""
    novel = current.select("gene_id").distinct().join(past, "gene_id", "left_anti").withColumn("state", F.lit("novel"))
    gone = past.select("gene_id").distinct().join(current, "gene_id", "left_anti").withColumn("state", F.lit("absent"))
    return novel.unionByName(gone)


def covariate_summary(samples: DataFrame, group: str, numeric: list[str], category: str, levels: list[str]) -> DataFrame:
    """Per group: size, mean and sample deviation of numeric covariates, counts per category level."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in numeric:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_sd")]
    aggs += [F.count_if(F.col(category) == level).alias(f"{category}_{level}") for level in levels]
    return samples.groupBy(group).agg(*aggs)


def observed_levels(covariates: DataFrame, types: DataFrame) -> DataFrame:
    """Distinct levels per categorical covariate in byte order."""
    kept = covariates.join(types.filter(F.col("type") == "categorical"), ["study_id", "name"], "left_semi")
    return kept.groupBy("study_id", "name").agg(F.array_sort(F.collect_set("value")).alias("levels"))


def annotation_from_exons(exons: DataFrame) -> DataFrame:
    """One annotation row per gene; the last exon row of a gene in file order decides."""
    last = F.max_by(F.struct("gene_symbol", "biotype", F.col("chrom").alias("chromosome")), F.struct("source", "record"))
    return exons.groupBy("gene_id").agg(last.alias("a")).select("gene_id", "a.*")


def exon_totals(exons: DataFrame) -> DataFrame:
    return exons.agg(
        F.count(F.lit(1)).alias("exon_rows"),
        F.count_distinct("gene_id").alias("genes"),
        F.sum(F.col("end") - F.col("start") + 1).alias("bases"),
    )
