"""Steps whose cost must grow no faster than their input."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from exprspark.functions import sequence as seq
from exprspark.operators import cohort, overlap
from exprspark.plans import record_queries
from exprspark.plans.registry import QUERIES, SQL
from exprspark.sources import records
from exprspark.sources.tsv import scan_tsv
from tests.fixtures import write
from tests.oracle import compare, connect


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of 256 bytes."""
    kept = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name in kept:
        spark.conf.set(name, "256")
    yield
    for name, value in kept.items():
        spark.conf.set(name, value)


def fastq(tmp_path, n=60):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        size = int(rng.integers(1, 120))
        rows.append((f"@r{i}", "".join(rng.choice(list("ACGT"), size)), "+", "I" * size))
    return rows, write(tmp_path, "r.fastq", "".join("\n".join(r) + "\n" for r in rows) + "@cut\nACGT\n")


def test_fastq_records_cut_by_blocks_are_whole(spark, tmp_path, small_blocks):
    rows, path = fastq(tmp_path)
    reads = records.read_fastq(spark, path)
    got = {r["rec_idx"]: (r["header"], r["seq"], r["plus"], r["qual"], r["problem"]) for r in reads.collect()}
    assert got.pop(len(rows)) == ("@cut", "ACGT", None, None, "truncated")
    assert [got[i] for i in range(len(rows))] == [(*r, None) for r in rows]


def test_fastq_text_is_not_joined_by_sorting(spark, tmp_path):
    _, path = fastq(tmp_path)
    plan = plan_of(records.read_fastq(spark, path))
    assert "SortMergeJoin" not in plan and "MapInArrow" in plan


def test_fastq_text_is_read_back_across_blocks(spark, tmp_path, small_blocks):
    rows, path = fastq(tmp_path)
    kept = records.read_fastq(spark, path).filter("problem IS NULL")
    text = records.fastq_text(kept)
    assert sorted(r["value"] for r in text.collect()) == sorted("\n".join(r) for r in rows)
    assert "SortMergeJoin" not in plan_of(text)


def test_quality_sums_equal_letter_by_letter_sums(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(chr(c) for c in rng.integers(33, 127, n)) for n in (1, 2, 1000, (1 << 16) + 3)] + ["", None, "!é~"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, q string")
    scores = seq.phred_scores(F.col("q"))
    total = F.aggregate(scores, F.lit(0).cast("bigint"), lambda a, b: a + b)
    errors = F.aggregate(F.transform(scores, seq.phred_error), F.lit(0.0), lambda a, b: a + b)
    for r in rows.select("q", seq.phred_sums(F.col("q")).alias("sums"), total.alias("t"), errors.alias("e")).collect():
        if r["q"] is None:
            assert r["sums"] is None
        else:
            assert r["sums"]["score_sum"] == r["t"] and r["sums"]["expected_errors"] == pytest.approx(r["e"], rel=1e-12)


def test_reads_across_stretches_and_gaps(spark):
    rng = np.random.default_rng(6)
    bases = "".join(rng.choice(list("ACGT"), 3 * overlap.STRETCH + 17))
    lines = [("c", i, 60, bases[60 * i: 60 * i + 60]) for i in range(-(-len(bases) // 60)) if i != 5]
    whole = bases[:300] + " " * 60 + bases[360:]
    chunks = spark.createDataFrame(lines, "chrom string, chunk long, width int, bases string")
    spans = [("near", [(1, 40), (100, 130)]), ("border", [(1000, 1100)]), ("far", [(10, 20), (3000, 3080)]), ("gap", [(290, 370)]), ("end", [(3080, 4000)])]
    rows = [(n + s, "c", iv, s) for n, iv in spans for s in "+-"] + [("past", "c", [(9000, 9010)], "+"), ("other", "d", [(1, 5)], "+")]
    origins = spark.createDataFrame(rows, "read_id string, chrom string, intervals array<struct<start:int,end:int>>, orientation string")
    read = overlap.spliced_sequence(origins, chunks)
    flip = str.maketrans("ACGT", "TGCA")
    want = {}
    for name, _, intervals, strand in rows[:-2]:
        text = "".join(whole[a - 1: b] for a, b in intervals).replace(" ", "")
        want[name] = text.translate(flip)[::-1] if strand == "-" else text
    assert {r["read_id"]: r["expected"] for r in read.collect()} == want
    # Reads are dealt by stretch, not line by line.
    assert "hashpartitioning(chrom" in plan_of(read) and not [x for x in plan_of(read).split("\n") if "hashpartitioning" in x and "chunk#" in x]


def test_cohort_totals_are_dealt_to_more_tasks_as_cells_grow(spark, monkeypatch):
    monkeypatch.setattr(cohort, "CELLS_PER_TASK", 50)
    items = spark.range(1000).selectExpr("id % 37 AS gene_id", "id % 11 AS sample_id", "id AS count")
    members = spark.createDataFrame([("full", i) for i in range(11)] + [("some", i) for i in (2, 3)], "cohort string, sample_id long")
    got = cohort.cohort_totals(items, members)
    want = {}
    for i in range(1000):
        for name in ["full"] + ["some"] * (i % 11 in (2, 3)):
            samples, total = want.setdefault((name, i % 37), (set(), 0))
            want[name, i % 37] = (samples | {i % 11}, total + i)
    assert {(r["cohort"], r["gene_id"]): (r["samples"], r["count"]) for r in got.collect()} == {k: (len(s), t) for k, (s, t) in want.items()}
    assert "hashpartitioning(gene_id#" in plan_of(got) and ", 20), REPARTITION_BY_NUM" in plan_of(got)


def test_both_mates_come_from_one_scan_and_ranges_from_the_jvm(spark):
    pairs = record_queries.paired_end(spark, "/root/testdata/sf0.001")
    assert plan_of(pairs).count("FileScan parquet") == 1
    rows = spark.createDataFrame([(float(i),) for i in range(12)], "at double")
    placed = overlap.ranged(rows, "at", [2.0, 2.5, 9.0], "n")
    assert [r["n"] for r in placed.orderBy("at").collect()] == [0, 0, 1, 2, 2, 2, 2, 2, 2, 3, 3, 3]
    assert "ArrowEvalPython" not in plan_of(placed)
    assert {r["n"] for r in overlap.ranged(rows, "at", [], "n").collect()} == {0}


def test_lines_of_a_table_file_stay_where_they_are_read(spark, tmp_path):
    path = write(tmp_path, "t.tsv", "a\tb\n" + "".join(f"{i}\t{i}\n" for i in range(50)))
    scan = scan_tsv(spark, path)
    assert scan.filter("problem IS NULL AND NOT is_head").count() == 50
    assert "SortMergeJoin" not in plan_of(scan)


def test_fastq_text_of_documents_is_written_compressed(spark, tmp_path):
    rows = [(i, f"line {i} of a text " * 40, "en") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    written = Path(record_queries.fastq_folder(spark, str(tmp_path)).removeprefix("file:"))
    assert 2 * sum(p.stat().st_size for p in written.glob("part-*")) < sum(4 * len(text) for _, text, _ in rows)
    back = record_queries.fastq_text_roundtrip(spark, str(tmp_path)).collect()
    assert sorted(r["value"].split("\n")[3] for r in back) == sorted(text.encode().hex().upper() for _, text, _ in rows)


def agrees_on_documents_without_text(spark, folder, name):
    langs = ["en", "de", "fr", "es", None]
    rows = [(10 * k + i, text, lang) for k, text in enumerate(["a text", "", None]) for i, lang in enumerate(langs)]
    rows += [(None, text, lang) for text in ("no id", None) for lang in langs]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.coalesce(1).write.parquet(f"{folder}/written")
    (part,) = (folder / "written").glob("part-*.parquet")
    (folder / "documents.parquet").symlink_to(part)
    return compare(spark, connect(str(folder)), str(folder), name, QUERIES[name], SQL[name])


def test_fastq_scan_keeps_documents_without_text(spark, tmp_path):
    assert agrees_on_documents_without_text(spark, tmp_path, "fastq_scan") is None


def test_fastq_text_keeps_documents_without_text(spark, tmp_path):
    assert agrees_on_documents_without_text(spark, tmp_path, "fastq_text_roundtrip") is None
