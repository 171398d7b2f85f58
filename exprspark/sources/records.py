"""Sequence and study text formats: FASTQ, FASTA, GTF, SAM and block-structured sample metadata."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from exprspark.functions.sequence import (
    FLAG_REVERSE,
    cigar_blocks,
    gtf_attribute,
    has_flag,
    is_primary,
    is_quality,
    is_sequence,
    is_spliced,
    tag_values,
)
from exprspark.functions.text import BLANKS, accession, after, before, title_condition, title_count_column
from exprspark.sources.lines import carry_forward, numbered_lines, placed_lines, raw_lines


LINES = ["header", "seq", "plus", "qual"]


def whole_records(lines: DataFrame) -> DataFrame:
    """Records whose four lines follow each other in scan order, put together where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, place, text = pa.array([], pa.string()), np.array([], dtype=np.int64), pa.array([], pa.large_string())
        for batch in batches:
            source = pa.concat_arrays([source, batch.column("source")])
            place = np.concatenate([place, batch.column("place").to_numpy()])
            text = pa.concat_arrays([text, batch.column("text").cast(pa.large_string())])
            first = np.arange(0, len(place) - 3, 4)
            whole = 4 * len(first)
            if not whole:
                continue
            own = place[:whole].reshape(-1, 4)
            if (own[:, 0] % 4).any() or (np.diff(own, axis=1) != 1).any():
                raise ValueError("lines left their scan order")
            parts = [text.take(pa.array(first + i)).cast(pa.string()) for i in range(4)]
            columns = [source.take(pa.array(first)), pa.array(own[:, 0] // 4), *parts]
            yield pa.RecordBatch.from_arrays(columns, names=["source", "rec_idx", *LINES])
            source, place, text = source.slice(whole), place[whole:], text.slice(whole)
        if len(place):
            raise ValueError("lines left their scan order")

    fields = ", ".join(f"{name} string" for name in LINES)
    return lines.select("source", "place", "text").mapInArrow(run, f"source string, rec_idx long, {fields}")


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Four-line records as ``(source, rec_idx, header, seq, plus, qual, problem)``, ``rec_idx`` from 0.

    A record that lies within a file block is put together by the task that reads it. Only lines of records cut by
    a block's border, and of a last one that lacks lines, are shuffled: at most six per block.
    """
    place = F.col("record") - 1
    lines = placed_lines(spark, paths).select(
        "source", place.alias("place"), F.floor(place / 4).alias("rec_idx"), "text", "block_first", "block_last"
    )
    first = F.col("rec_idx") * 4 + 1
    inside = (first >= F.col("block_first")) & (first + 3 <= F.col("block_last"))

    def part(i: int) -> Column:
        return F.max(F.when(F.col("place") % 4 == i, F.col("text")))

    cut = lines.filter(~inside).groupBy("source", "rec_idx").agg(*[part(i).alias(name) for i, name in enumerate(LINES)])
    records = whole_records(lines.filter(inside)).unionByName(cut)
    problem = (
        F.when(F.col("qual").isNull(), "truncated")
        .when(~F.col("header").startswith("@") | ~F.col("plus").startswith("+"), "delimiter")
        .when((F.length("seq") == 0) | (F.octet_length("seq") != F.octet_length("qual")), "length")
        .when(~is_sequence(F.col("seq")), "sequence")
        .when(~is_quality(F.col("qual")), "quality")
    )
    return records.withColumn("problem", problem)


def fastq_prefix(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records of each file in file order."""
    return records.filter(F.col("rec_idx") < n)


def systematic_sample(records: DataFrame, step: int, index: str = "rec_idx") -> DataFrame:
    """Every ``step``-th record, starting with record 0."""
    return records.filter(F.col(index) % step == 0)


def fastq_text(records: DataFrame) -> DataFrame:
    """Records as text rows of four lines each, ready for a text sink; NULL for a record that lacks a line."""
    whole = F.concat("header", F.lit("\n"), "seq", F.lit("\n"), "plus", F.lit("\n"), "qual")
    return records.select(whole.alias("value"))


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines tagged with the accession of the section they belong to."""
    text = F.col("text")
    is_header = text.startswith(">")
    name = F.split_part(F.substring(text, F.lit(2), F.length(text)), F.lit(" "), F.lit(1))
    tagged = carry_forward(numbered_lines(spark, paths), F.when(is_header, name), "accession")
    return tagged.select("source", "record", "accession", is_header.alias("is_header"), "text")


def fasta_lengths(fasta: DataFrame) -> DataFrame:
    """Sections and bases per accession."""
    return fasta.groupBy("accession").agg(
        F.count_if("is_header").alias("sections"),
        F.sum(F.when(~F.col("is_header"), F.length(F.trim("text", F.lit(BLANKS)))).otherwise(0)).alias("bases"),
    )


def read_gtf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Feature rows with their record number; comment lines are left out, odd rows carry a problem."""
    fields = F.split("text", "\t", -1)
    rows = numbered_lines(spark, paths).filter(~F.col("text").startswith("#")).withColumn("f", fields)
    sound = F.size("f") == 9

    def field(i: int) -> Column:
        return F.when(sound, F.col("f")[i])

    start, end = field(3).try_cast("bigint"), field(4).try_cast("bigint")
    return rows.select(
        "source",
        "record",
        field(0).alias("chrom"),
        field(2).alias("feature"),
        start.alias("start"),
        end.alias("end"),
        field(6).alias("strand"),
        field(8).alias("attributes"),
        F.when(~sound, "fields").when(start.isNull() | end.isNull() | (start < 1), "coordinates").alias("problem"),
    )


def outside_reference(features: DataFrame, lengths: DataFrame) -> DataFrame:
    """Features that do not lie within their accession: ``lengths(accession, bases)``."""
    known = lengths.select(F.col("accession").alias("chrom"), "bases")
    joined = features.join(known, "chrom", "left")
    return joined.filter((F.col("start") < 1) | F.col("bases").isNull() | (F.col("end") > F.col("bases")))


def gtf_violations(features: DataFrame) -> DataFrame:
    """``source, record, rule``: rows that could not be read, and exons that name no gene."""
    nameless = (F.col("feature") == "exon") & (gtf_attribute(F.col("attributes"), "gene_id") == "")
    rule = F.coalesce(F.col("problem"), F.when(nameless, "gene_id"))
    return features.withColumn("rule", rule).filter(F.col("rule").isNotNull()).select("source", "record", "rule")


def refuse(rule: Column, place: Column, value: Column) -> Column:
    """The value where no rule is broken; a broken one fails the job and names the place."""
    told = F.concat(F.lit("broken record, "), rule, F.lit(": "), place)
    return F.when(rule.isNotNull(), F.raise_error(told)).otherwise(value)


def exon_rows(features: DataFrame, chrom: str | None = None) -> DataFrame:
    """Exons with their gene's names, of one chromosome if given. A row that ``gtf_violations`` lists fails the job."""
    broken = F.col("problem").isNotNull()
    wanted = F.col("feature") == "exon"
    wanted = wanted if chrom is None else wanted & (F.col("chrom") == chrom)
    names = {"gene_id": "gene_id", "gene_symbol": "gene", "biotype": "gene_biotype"}
    found = {out: gtf_attribute(F.col("attributes"), key) for out, key in names.items()}
    rule = F.coalesce(F.col("problem"), F.when(found["gene_id"] == "", "gene_id"))
    place = F.concat(F.col("source"), F.lit(" record "), F.col("record").cast("string"))
    found["gene_id"] = refuse(rule, place, found["gene_id"])
    return features.filter(broken | wanted).withColumns(found).filter(F.col("gene_id").isNotNull())


def sam_violations(records: DataFrame) -> DataFrame:
    """``source, read_id, rule``: records without a readable flag, and mapped primary ones without one readable ``NH`` tag."""
    return records.filter(F.col("problem").isNotNull()).select("source", "read_id", F.col("problem").alias("rule"))


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Alignment records; order is not needed, so the lines are not numbered and nothing is shuffled."""
    rows = raw_lines(spark, paths).filter(~F.col("text").startswith("@"))
    f = F.col("f")
    nh = tag_values(F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0))), "NH:i:")
    flag = f[1].try_cast("int")
    parsed = rows.withColumn("f", F.split("text", "\t", -1)).select(
        "source",
        f[0].alias("read_id"),
        flag.alias("flag"),
        f[2].alias("chrom"),
        f[3].try_cast("int").alias("pos"),
        F.try_element_at(f, F.lit(6)).alias("cigar"),
        F.when(F.size(nh) == 1, F.try_element_at(nh, F.lit(1)).try_cast("int")).alias("nh"),
    )
    return parsed.withColumns(
        {
            "primary": is_primary(F.col("flag")),
            "spliced": is_spliced(F.col("cigar")),
            "strand": F.when(has_flag(F.col("flag"), FLAG_REVERSE), "-").otherwise("+"),
            "problem": F.when(F.col("flag").isNull(), "flag").when(
                is_primary(F.col("flag")) & F.col("nh").isNull(), "nh_tag"
            ),
        }
    )


def alignments(sam: DataFrame) -> DataFrame:
    """Alignment records in the shape the overlap join takes."""
    mate = F.when(has_flag(F.col("flag"), 64), 1).when(has_flag(F.col("flag"), 128), 2).otherwise(0)
    return sam.select(
        "read_id",
        "chrom",
        "strand",
        mate.alias("mate"),
        "nh",
        has_flag(F.col("flag"), 4).alias("unmapped"),
        F.when(~has_flag(F.col("flag"), 4), cigar_blocks(F.col("pos"), F.col("cigar"))).alias("blocks"),
    )


# Keys and labels of the sample metadata format.
SOFT_LABELS = {
    "age (years)": "age",
    "Sex": "sex",
    "postmortem interval (hours)": "pmi",
    "rin": "rin",
}
SOFT_COLUMNS = ["condition", "title", "count_column", "experiment", "age", "sex", "pmi", "rin"]
SOFT_TITLE = r"\A(control|bipolar)-[0-9]+\z"
SOFT_PREFIXES = {"control": "C_", "bipolar": "BD_"}


def read_soft(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Metadata entries ``(source, record, sample_id, key, value)`` of blocks opened by ``^SAMPLE = id``."""
    text = F.col("text")
    opener = F.when(text.startswith("^SAMPLE = "), after(text, "^SAMPLE = "))
    tagged = carry_forward(numbered_lines(spark, paths), opener, "sample_id")
    inside = tagged.filter(F.col("sample_id").isNotNull() & text.contains(" = "))
    return inside.select(
        "source", "record", "sample_id", before(text, " = ").alias("key"), after(text, " = ").alias("value")
    )


OPENED = "opened"


def soft_samples(entries: DataFrame) -> DataFrame:
    """One row per sample. A later entry of the same name replaces an earlier one; a sample opened twice fails the job."""
    gathered = soft_values(entries)
    twice = F.when(F.col("times") > 1, F.lit("repeated_sample"))
    checked = gathered.withColumn("sample_id", refuse(twice, F.col("sample_id"), F.col("sample_id")))
    some = F.coalesce(*SOFT_COLUMNS).isNotNull()
    return checked.filter(F.col("sample_id").isNotNull() & some).drop("times")


def soft_values(entries: DataFrame) -> DataFrame:
    """The values of each sample and how many ``times`` it is opened."""
    key, value = F.col("key"), F.col("value")
    labels = F.create_map(*[F.lit(x) for pair in SOFT_LABELS.items() for x in pair])
    title = (key == "!Sample_title") & value.rlike(SOFT_TITLE)
    fields = F.array(
        F.when(title, F.struct(F.lit("title").alias("name"), value.alias("v"))),
        F.when(title, F.struct(F.lit("condition").alias("name"), title_condition(value).alias("v"))),
        F.when(title, F.struct(F.lit("count_column").alias("name"), title_count_column(value, SOFT_PREFIXES).alias("v"))),
        F.when(key == "!Sample_relation", F.struct(F.lit("experiment").alias("name"), accession(value).alias("v"))),
        F.when(
            key == "!Sample_characteristics_ch1",
            F.struct(F.try_element_at(labels, before(value, ": ")).alias("name"), after(value, ": ").alias("v")),
        ),
    )
    opened = F.when(key == "^SAMPLE", F.struct(F.lit(OPENED).alias("name"), value.alias("v")))
    long = entries.select("sample_id", "record", F.explode(F.array_append(fields, opened)).alias("f"))
    long = long.filter("f.v is not null and f.name is not null").select("sample_id", "record", "f.name", "f.v")
    # The openers of a sample are counted in the same pass as its values are gathered.
    times = F.count_if(F.col("name") == OPENED)
    values = [F.max_by("v", F.when(F.col("name") == c, F.col("record"))).alias(c) for c in SOFT_COLUMNS]
    values = [F.when(F.count_if(F.col("name") == c) > 0, v).alias(c) for c, v in zip(SOFT_COLUMNS, values)]
    return long.groupBy("sample_id").agg(times.alias("times"), *values)


def soft_problems(entries: DataFrame) -> DataFrame:
    """Entries that break the study's rules, and samples opened twice or left incomplete."""
    key, value = F.col("key"), F.col("value")
    label = before(value, ": ")
    rule = (
        F.when((key == "!Sample_title") & ~value.rlike(SOFT_TITLE), "title")
        .when((key == "!Sample_characteristics_ch1") & ~label.isin(*SOFT_LABELS), "label")
    )
    bad = entries.withColumn("rule", rule).filter("rule is not null").select("sample_id", "record", "rule")
    opened = (
        entries.filter(key == "^SAMPLE")
        .groupBy("sample_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("record").alias("record"))
        .filter("n > 1")
        .select("sample_id", "record", F.lit("repeated_sample").alias("rule"))
    )
    missing = F.lit(False)
    for column in SOFT_COLUMNS:
        missing = missing | F.col(column).isNull()
    incomplete = soft_values(entries).filter(missing).select(
        "sample_id", F.lit(None).cast("long").alias("record"), F.lit("incomplete").alias("rule")
    )
    return bad.unionByName(opened).unionByName(incomplete)
