"""Dialect, numbering and the text formats."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from exprspark.functions import sequence as seq
from exprspark.functions import text as tx
from exprspark.operators import cohort, compare
from exprspark.sources import files, records
from exprspark.sources.counts import read_matrix
from exprspark.sources.lines import numbered_lines
from exprspark.sources.tsv import TableFormatError, read_settings, read_table, scan_tsv
from exprspark.sinks.tables import write_cohorts, write_lines, write_matrix, write_records, write_results
from tests.fixtures import tsv, write

MALFORMED = {
    "empty file": b"",
    "duplicate header": b"a\ta\n1\t2\n",
    "empty header": b"a\t\n1\t2\n",
    "short row": b"a\tb\n1\n",
    "long row": b"a\tb\n1\t2\t3\n",
    "blank line": b"a\tb\n\n1\t2\n",
    "comment line": b"a\tb\n#1\t2\n",
    "unclosed quote": b'a\tb\n"1\t2\n',
    "text after quote": b'a\tb\n"1"x\t2\n',
    "quote in bare cell": b'a\tb\n1"\t2\n',
    "tab in quotes": b'a\tb\n"1\t1"\t2\n',
    "newline in quotes": b'a\tb\n"1\n1"\t2\n',
    "lone CR at end": b"a\tb\n1\t2\r",
    "lone CR inside": b"a\tb\n1\r1\t2\n",
    "late BOM": b"a\tb\n\xef\xbb\xbf1\t2\n",
    "NUL": b"a\tb\n1\x00\t2\n",
    "overlong": b"a\tb\n\xc0\xaf\t2\n",
    "surrogate": b"a\tb\n\xed\xa0\x80\t2\n",
    "beyond range": b"a\tb\n\xf4\x90\x80\x80\t2\n",
    "cut sequence": b"a\tb\n\xe2\x82\t2\n",
}


@pytest.mark.parametrize("name", MALFORMED)
def test_malformed_tables_are_rejected(spark, tmp_path, name):
    path = write(tmp_path, "bad.tsv", MALFORMED[name])
    with pytest.raises(TableFormatError):
        read_table(spark, path)


def test_sound_dialect(spark, tmp_path):
    path = write(tmp_path, "ok.tsv", b'\xef\xbb\xbfa\tb\r\n"x""y"\t\r\n\xe2\x82\xac\t"#z"\n"p q"\tlast')
    rows = read_table(spark, path).orderBy("_record").collect()
    assert [(r["_record"], r["a"], r["b"]) for r in rows] == [(2, 'x"y', ""), (3, "€", "#z"), (4, "p q", "last")]


def test_records_are_numbered_over_file_splits(spark, tmp_path):
    for f, n in (("one", 5000), ("two", 3)):
        write(tmp_path, f"in/{f}.txt", "".join(f"{f} {i + 1}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = numbered_lines(spark, str(tmp_path / "in"))
        wrong = lines.filter(F.split("text", " ")[1].cast("long") != F.col("record")).count()
        assert lines.rdd.getNumPartitions() > 5
        assert lines.count() == 5003 and wrong == 0 and lines.filter("is_last").count() == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rejects_name_record_and_column(spark, tmp_path):
    path = write(tmp_path, "bad.tsv", b'a\tb\n1\tx"\n1\n')
    found = scan_tsv(spark, path).filter("problem is not null").orderBy("record").collect()
    assert [(r["record"], r["problem"]["rule"], r["problem"]["column"]) for r in found] == [(2, "quoting", 2), (3, "ragged", 1)]


def test_settings(spark, tmp_path):
    assert read_settings(spark, write(tmp_path, "s.tsv", tsv([("key", "value"), ("a", 1), ("b", "")]))) == {"a": "1", "b": ""}
    with pytest.raises(TableFormatError):
        read_settings(spark, write(tmp_path, "d.tsv", tsv([("key", "value"), ("a", 1), ("a", 2)])))


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value,expected",
    [("0", 0), ("007", 7), ("18446744073709551615", 18446744073709551615), ("18446744073709551616", None), ("", None), ("-1", None),
     ("+1", None), ("1.0", None), ("1e3", None), (" 1", None), ("1 ", None), ("NaN", None), ("1\n", None)],
)
def test_uint64(spark, value, expected):
    got = one(spark, value, tx.uint64_value)
    assert (None if got is None else int(got)) == expected


@pytest.mark.parametrize(
    "value,expected",
    [("1", 1.0), ("+.5", 0.5), ("-2.", -2.0), ("1e-3", 1e-3), ("0e5", 0.0), ("1e999", None), ("1e-999", None), ("NaN", None), ("Inf", None),
     ("0x1", None), ("1d", None), (" 1", None), (".", None), ("1e", None), ("", None)],
)
def test_decimal(spark, value, expected):
    assert one(spark, value, tx.decimal_value) == expected


def test_small_text_functions(spark):
    assert one(spark, "A.1_b-", tx.valid_id) is True and one(spark, "-a", tx.valid_id) is False and one(spark, "a\n", tx.valid_id) is False
    assert one(spark, "x_1", tx.valid_identifier) is True and one(spark, "1x", tx.valid_identifier) is False
    assert one(spark, "control-2", lambda c: tx.title_count_column(c, records.SOFT_PREFIXES)) == "C_2"
    assert one(spark, "bipolar-4", lambda c: tx.title_count_column(c, records.SOFT_PREFIXES)) == "BD_4"
    assert one(spark, "2 days", tx.syntactic_name) == "X2.days" and one(spark, ".2a", tx.syntactic_name) == "X.2a"
    assert one(spark, '#a"b', tx.quote) == '"#a""b"' and one(spark, "plain", tx.quote) == "plain"
    assert one(spark, "/m/runs.tsv", lambda c: tx.resolve_path(c, F.lit("x/y"))) == "/m/x/y"
    assert one(spark, "file:/tmp/a%20b+c", tx.plain_path) == "/tmp/a b+c"


def test_cigar_and_intervals(spark):
    def blocks(cigar):
        found = one(spark, cigar, lambda c: seq.cigar_blocks(F.lit(264), c))
        return [tuple(b) for b in found]

    assert blocks("37M200N38M") == [(264, 300), (501, 538)]
    assert blocks("5S10M2I3D4=1X6H") == [(264, 281)]
    assert blocks("10M5N3I5N10M") == [(264, 273), (284, 293)]
    assert blocks("75M") == [(264, 338)] and blocks("*") == []
    assert [tuple(i) for i in one(spark, "264-300,501-538", seq.parse_intervals)] == [(264, 300), (501, 538)]
    assert one(spark, "AACGN", seq.reverse_complement) == "NCGTT"
    assert list(one(spark, "!I~", seq.phred_scores)) == [0, 40, 93]


def test_fastq_problems(spark, tmp_path):
    good = "@a\nAC\n+\n!!\n"
    cases = {"ok": good, "length": "@a\nAC\n+\n!\n", "delimiter": "bad\nAC\n+\n!!\n", "truncated": "@a\nAC\n+", "sequence": "@a\nAX\n+\n!!\n", "quality": "@a\nAC\n+\n! \n"}
    for name, text in cases.items():
        write(tmp_path, f"reads/{name}.fastq", good + text)
    got = records.read_fastq(spark, str(tmp_path / "reads")).filter("rec_idx = 1").collect()
    assert {r["source"].rsplit("/", 1)[1].split(".")[0]: r["problem"] for r in got} == {k: None if k == "ok" else k for k in cases}


def test_fastq_sampling_and_text_sink(spark, tmp_path):
    path = write(tmp_path, "r.fastq", "".join(f"@r{i}\nACGT\n+\nIIII\n" for i in range(23)))
    reads = records.read_fastq(spark, path)
    assert sorted(r["header"] for r in records.fastq_prefix(reads, 3).collect()) == ["@r0", "@r1", "@r2"]
    kept = records.systematic_sample(reads, 5)
    assert sorted(r["rec_idx"] for r in kept.collect()) == [0, 5, 10, 15, 20]
    write_lines(records.fastq_text(kept), str(tmp_path / "out"))
    assert records.read_fastq(spark, str(tmp_path / "out")).filter("problem is null").count() == 5


def test_fasta_gtf_sam(spark, tmp_path):
    fasta = records.read_fasta(spark, write(tmp_path, "r.fa", ">c1 first\nACGT\nAC\n>c2\nGGG\n"))
    assert {r["accession"]: r["bases"] for r in records.fasta_lengths(fasta).collect()} == {"c1": 6, "c2": 3}
    line = 'c1\tx\texon\t{}\t{}\t.\t+\t.\tgene_id "g1"; gene "{}"; gene_biotype "lnc";\n'
    gtf = records.read_gtf(spark, write(tmp_path, "a.gtf", "#!x\n" + line.format(1, 4, "one") + line.format(3, 9, "two") + "short\trow\n"))
    assert [r["record"] for r in gtf.filter("problem = 'fields'").collect()] == [4]
    outside = records.outside_reference(gtf.filter("problem is null"), records.fasta_lengths(fasta))
    assert [r["end"] for r in outside.collect()] == [9]
    assert {r["gene_symbol"] for r in records.exon_rows(gtf.filter("problem is null"), "c1").collect()} == {"one", "two"}
    sam = "@HD\tVN:1\n" + "".join(
        f"{n}\t{f}\tc1\t1\t60\t{c}\t*\t0\t0\tA\tI\t{t}\n" for n, f, c, t in [("a", 0, "5M", "NH:i:1"), ("b", 256, "5M", "NH:i:2"), ("c", 16, "2M3N2M", "NH:i:3\tNH:i:3")]
    )
    got = {r["read_id"]: r for r in records.read_sam(spark, write(tmp_path, "x.sam", sam)).collect()}
    assert got["a"]["primary"] and not got["b"]["primary"] and got["c"]["spliced"] and got["c"]["problem"] == "nh_tag" and got["c"]["strand"] == "-"
    aligned = records.alignments(records.read_sam(spark, str(tmp_path / "x.sam")))
    assert [tuple(b) for b in aligned.filter("read_id = 'c'").first()["blocks"]] == [(1, 2), (6, 7)]


def test_soft_problems(spark, tmp_path):
    block = "^SAMPLE = {}\n!Sample_title = {}\n!Sample_characteristics_ch1 = {}: 1\n"
    entries = records.read_soft(spark, write(tmp_path, "f.soft", "!x = y\n" + block.format("G1", "case-1", "rin") + block.format("G1", "control-1", "colour")))
    rules = sorted(r["rule"] for r in records.soft_problems(entries).collect())
    assert rules == ["incomplete", "label", "repeated_sample", "title"]


def test_inventory_logs_json_and_sinks(spark, tmp_path):
    for name, content in {"a/x.bin": b"one", "a/b/y z.bin": b"two"}.items():
        write(tmp_path, f"tree/{name}", content)
    got = {r["path"]: r["sha256"] for r in files.inventory(spark, str(tmp_path / "tree")).collect()}
    assert got == {"a/x.bin": hashlib.sha256(b"one").hexdigest(), "a/b/y z.bin": hashlib.sha256(b"two").hexdigest()}
    log = files.read_resource_logs(spark, write(tmp_path, "t.log", "start\n\tElapsed: 1: 2\n"))
    assert [(r["key"], r["value"]) for r in log.collect()] == [("Elapsed", "1: 2")]
    doc = write(tmp_path, "p.json", '{"sampling": "s",\n "reads": [{"run_id": "r1"}, {"run_id": "r2"}]}')
    assert files.read_provenance(spark, doc).select("read.run_id").count() == 2
    table = spark.createDataFrame([("g1", 1.5, ""), ("g 2 ", None, 'q"')], "gene_id string, v double, t string")
    write_results(table, str(tmp_path / "res"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "res").glob("*.csv")))
    assert '"g1"\t"1.5"\t""' in text and '"g 2 "\t"NA"\t"q"""' in text
    write_records(table, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    with pytest.raises(Exception, match="already exists"):
        write_results(table, str(tmp_path / "res"))
    write_cohorts(spark.createDataFrame([("full", "s1", 1)], "cohort string, sample_id string, count int"), str(tmp_path / "cohorts"))
    assert spark.read.parquet(str(tmp_path / "cohorts")).filter("cohort = 'full'").count() == 1


def test_large_files_are_hashed_in_turns_of_bounded_reads(spark, tmp_path, monkeypatch):
    rng = random.Random(7)
    noise = rng.randbytes(9_000) + b"\r\n\n\r\xff" + rng.randbytes(9_000)
    contents = {
        "a/noise.bin": noise, "a/feed.bin": noise + b"\n", "b c/mark+.bin": b"\xef\xbb\xbf" + noise, "b c/both.bin": b"\xef\xbb\xbf" + noise + b"\n",
        "feeds.bin": b"\n" * 7_000, "one.bin": b"x" * 9_000, "marks.bin": b"\xef\xbb\xbf" * 2_000, "packed.gz": gzip.compress(noise),
        "edge.bin": b"\n" * 3_000, "small.bin": b"one",
    }
    for name, content in contents.items():
        write(tmp_path, f"tree/{name}", content)
    want = {(n, len(c), hashlib.sha256(c).hexdigest(), hashlib.md5(c).hexdigest()) for n, c in contents.items()}
    read = []
    carried = files.hashed_in_turns
    monkeypatch.setattr(files, "hashed_in_turns", lambda *given: read.append(given[2]) or carried(*given))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = files.inventory(spark, str(tmp_path / "tree"), 3_000).collect()
        most = files.file_pieces(spark, str(tmp_path / "tree"), 3_000).filter("path LIKE '%noise.bin'").groupBy("block").agg(F.sum(F.octet_length("content")))
        assert most.count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert len(got) == len(want) and set(map(tuple, got)) == want
    assert read == [3_000]
    assert set(map(tuple, files.inventory(spark, str(tmp_path / "tree")).collect())) == want and read == [3_000]


def test_wide_tables(spark, tmp_path):
    names = ["s 1", 'q"2', "s`3"]
    rows = spark.createDataFrame(
        [("g2", [1.0, None, 1e-300]), ('a"b', [float("nan"), -0.1, 3.0]), ("#g", [1e22, 0.1 + 0.2, 0.0])], "gene_id string, x array<double>"
    )
    path = str(tmp_path / "wide")
    write_matrix(rows, ["gene_id"], "x", names, path, ["gene_id"])
    lines = [x for p in sorted((tmp_path / "wide").glob("*.csv")) for x in p.read_text().splitlines()]
    assert lines[0] == '"gene_id"\t"s 1"\t"q""2"\t"s`3"' and '"g2"\t1.0\tNA\t1.0E-300' in lines
    assert [x.split("\t")[0] for x in lines if x != lines[0]] == ['"#g"', '"a""b"', '"g2"']
    back, found = read_matrix(spark, path, ["gene_id"])
    assert found == names and {(r[0], str(r[1])) for r in back.collect()} == {(r[0], str(r[1])) for r in rows.collect()}
    empty = str(tmp_path / "empty")
    write_matrix(rows.filter("gene_id = 'none'"), ["gene_id"], "x", names, empty, ["gene_id"])
    back, found = read_matrix(spark, empty, ["gene_id"])
    assert found == names and back.count() == 0
    with pytest.raises(Exception, match="one value per name"):
        write_matrix(rows, ["gene_id"], "x", names[:2], str(tmp_path / "short"))
    with pytest.raises(Exception, match="tab or line break"):
        write_matrix(rows.withColumn("gene_id", F.lit("a\tb")), ["gene_id"], "x", names, str(tmp_path / "tab"))
    with pytest.raises(TableFormatError, match="expected"):
        read_matrix(spark, path, ["sample_id"])


def test_published_matrix(spark, tmp_path):
    import gzip

    text = tsv([("Ensembl_ID", "GeneSymbol", "Biotype", "Chromosome", "C_1", "BD_2"), ("E1", "s", "b", "1", 3, 4)])
    path = write(tmp_path, "m.txt.gz", gzip.compress(text.encode()))
    annotation, counts = files.read_published_matrix(spark, path)
    assert annotation.columns == ["gene_id", "gene_symbol", "biotype", "chromosome"]
    assert {(r["count_column"], r["count"]) for r in counts.collect()} == {("C_1", "3"), ("BD_2", "4")}


GTF_HEAD = "c1\tx\texon\t1\t9\t.\t+\t.\t"


@pytest.mark.parametrize("line, rule", [("c1\tx\texon\t1\t9", "fields"), (GTF_HEAD.replace("\t1\t9", "\tone\t9") + 'gene_id "a";', "coordinates"), (GTF_HEAD + 'gene "a";', "gene_id")])
def test_broken_annotation_rows_are_listed_and_refused(spark, tmp_path, line, rule):
    features = records.read_gtf(spark, write(tmp_path, "x.gtf", GTF_HEAD + 'gene_id "a";\n' + line + "\n"))
    assert [(r["record"], r["rule"]) for r in records.gtf_violations(features).collect()] == [(2, rule)]
    with pytest.raises(Exception, match=rule):
        records.exon_rows(features).collect()
    with pytest.raises(Exception, match=rule):
        cohort.exon_totals(records.exon_rows(features)).collect()


@pytest.mark.parametrize("tags", ["AS:i:0", "NH:i:1\tNH:i:1", "NH:i:x"])
def test_mapped_records_without_a_hit_count_are_listed_and_refused(spark, tmp_path, tags):
    good, bad = (f"{name}\t0\tc1\t1\t255\t9M\t*\t0\t0\t*\t*\t{t}" for name, t in (("a", "NH:i:1"), ("b", tags)))
    sam = records.read_sam(spark, write(tmp_path, "x.sam", f"{good}\n{bad}\n"))
    assert [(r["read_id"], r["rule"]) for r in records.sam_violations(sam).collect()] == [("b", "nh_tag")]
    inputs = spark.createDataFrame([(1, 9)], "run int, input_reads long")
    with pytest.raises(Exception, match="nh_tag"):
        compare.mapping_metrics(sam.withColumn("run", F.lit(1)), inputs, ["run"]).collect()
    short = spark.createDataFrame([(1, 0)], "run int, input_reads long")
    with pytest.raises(Exception, match="more mapped"):
        compare.mapping_metrics(sam.filter("read_id = 'a'").withColumn("run", F.lit(1)), short, ["run"]).collect()


def test_a_sample_opened_twice_is_refused(spark, tmp_path):
    block = "^SAMPLE = GSM1\n!Sample_title = control-1\n"
    entries = records.read_soft(spark, write(tmp_path, "x.soft", block + block))
    assert "repeated_sample" in {r["rule"] for r in records.soft_problems(entries).collect()}
    with pytest.raises(Exception, match="repeated_sample"):
        records.soft_samples(entries).collect()
