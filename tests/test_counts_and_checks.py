"""Count merge, bundle checks, overlap assignment and ordered operators against hand-made or brute-force answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from exprspark.functions import sequence as seq
from exprspark.operators import checks, cohort, compare, counts, overlap
from exprspark.operators.counts import annotate, dense, merge_runs, pack
from exprspark.operators.ordering import adjust_p, exact_quantiles, ordered_counts, rejections
from exprspark.plans.merge import check_bundle, merge_counts
from exprspark.session import Workspace
from exprspark.sinks.tables import write_counts
from exprspark.sources import records
from exprspark.sources.counts import read_summaries, sole_count_column, typed_counts, wide_to_long
from exprspark.sources.tsv import read_table, scan_tsv
from tests.fixtures import EXPECTED, GENES, SAMPLE_ORDER, bundle, small_study, tsv, write


def merged(spark, p, **kw):
    return merge_counts(spark, p["samples"], p["runs"], p["genes"], p["inputs"], **kw)


@pytest.mark.parametrize("mixed", [False, True])
def test_merge_gives_the_expected_matrix(spark, tmp_path, mixed):
    paths = small_study(tmp_path, mixed)
    got = merged(spark, paths, annotation_path=paths["annotation"])
    assert got.sample_ids == SAMPLE_ORDER
    write_counts(got.matrix, got.sample_ids, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    header = "gene_id\t" + "\t".join(SAMPLE_ORDER)
    body = [line for p in parts for line in p.read_text().splitlines() if line != header]
    assert body == ["\t".join([g, *map(str, EXPECTED[g])]) for g in GENES]


@pytest.mark.parametrize(
    "edit,message",
    [
        ("missing", "1 genes missing"), ("twice", "repeated"), ("header", "header"), ("overflow", "count_value"), ("empty", "empty_file"),
    ],
)
def test_bad_run_files_are_refused(spark, tmp_path, edit, message):
    paths = small_study(tmp_path)
    target = tmp_path / "counts/run_t1.tsv"
    lines = target.read_text().splitlines()
    changed = {
        "missing": lines[:-1], "twice": lines + [lines[-1]], "header": ["gene\tcount"] + lines[1:],
        "overflow": lines[:-1] + ["gene_A.1\t18446744073709551616"], "empty": [],
    }[edit]
    target.write_text("".join(line + "\n" for line in changed))
    with pytest.raises(checks.ContractError, match=message):
        merged(spark, paths)


def test_bad_summaries_are_listed(spark, tmp_path):
    texts = {"none": "Status\tmine.bam\nUnassigned\t1\n", "twice": "Status\tmine.bam\nAssigned\t1\nAssigned\t1\n",
             "other": "Status\tother\nAssigned\t1\n", "text": "Status\tmine.bam\nAssigned\tx\n", "good": "Status\tmine.bam\nAssigned\t1\n"}
    for name, text in texts.items():
        write(tmp_path, f"{name}.summary", text)
    inputs = spark.createDataFrame([(n, str(tmp_path / n), "mine.bam") for n in texts], "run_id string, path string, column string")
    found = {(r["source"].rsplit("/", 1)[1].split(".")[0], r["rule"]) for r in read_summaries(spark, inputs).problems.collect()}
    assert found == {("none", "assigned_missing"), ("twice", "repeated_status"), ("other", "column_missing"), ("text", "count_value")}


def test_sums_are_whole_up_to_uint64(spark):
    runs = spark.createDataFrame([("r1", "s"), ("r2", "s")], "run_id string, sample_id string")
    big = [("r1", "g", "18446744073709551614"), ("r2", "g", "1")]
    counts = spark.createDataFrame(big, "run_id string, gene_id string, c string").select("run_id", "gene_id", F.col("c").cast("decimal(20,0)").alias("count"))
    assert int(merge_runs(counts, runs).first()["count"]) == 18446744073709551615
    over = counts.withColumn("count", F.when(F.col("run_id") == "r2", F.lit(2)).otherwise(F.col("count")).cast("decimal(20,0)"))
    with pytest.raises(Exception, match="exceeds uint64"):
        merge_runs(over, runs).collect()
    longs = spark.createDataFrame([("r1", "g", 2**62), ("r2", "g", 2**62 + 5)], "run_id string, gene_id string, count bigint")
    assert int(merge_runs(longs, runs).first()["count"]) == 2**63 + 5


def test_sole_column_and_wide(spark, tmp_path):
    path = write(tmp_path, "t.tab", "# x\n" + tsv([("Geneid", "Chr", "Start", "End", "Strand", "Length", "only.bam"), ("g", 1, 1, 2, "+", 2, 5)]))
    assert sole_count_column(scan_tsv(spark, path, leading_comments=True)).first()["column"] == "only.bam"
    wide = read_table(spark, write(tmp_path, "w.tsv", tsv([("gene_id", "s1", "s2"), ("g1", 1, "x"), ("g2", 3, 4)])))
    long = typed_counts(wide_to_long(wide, ["s1", "s2"]))
    assert {(r["gene_id"], r["sample_id"]): r["count"] and int(r["count"]) for r in long.collect()} == {
        ("g1", "s1"): 1, ("g1", "s2"): None, ("g2", "s1"): 3, ("g2", "s2"): 4}


def test_annotation_keeps_rows(spark):
    table = spark.createDataFrame([("g1", 1), ("g2", 2)], "gene_id string, v int")
    notes = spark.createDataFrame([("g1", "S", "", "c")], "gene_id string, gene_symbol string, biotype string, chromosome string")
    assert [tuple(r) for r in annotate(table, notes).orderBy("gene_id").collect()] == [("g1", 1, "S", None, "c"), ("g2", 2, None, None, None)]


def test_dense_and_pack(spark):
    cells = spark.createDataFrame([("g1", "a", 1), ("g1", "b", 2), ("g2", "a", 3)], "gene_id string, sample_id string, count int")
    universe = spark.createDataFrame([("g1",), ("g2",), ("g3",)], "gene_id string")
    full = dense(cells, ["a", "b"], universe)
    order = spark.createDataFrame([("b", 0), ("a", 1)], "sample_id string, ordinal int")
    assert {r["gene_id"]: list(r["y"]) for r in pack(full, order).collect()} == {"g1": [2, 1], "g2": [0, 3], "g3": [0, 0]}
    assert pack(cells.withColumn("sample_id", F.lit("zz")), order).agg(F.sum("strangers")).first()[0] == 3


def test_sound_bundle_has_no_violations(spark, tmp_path):
    p = bundle(tmp_path)
    found = check_bundle(spark, p["samples"], p["runs"], p["references"], p["settings"], p["contrasts"])
    assert found.collect() == []
    checks.enforce(found)


@pytest.mark.parametrize(
    "file,old,new,rule",
    [
        ("settings", "alpha\t0.05", "alpha\t1", "alpha_out_of_range"),
        ("contrasts", "\ttreated\t", "\tabsent\t", "level_not_observed"),
        ("references", "annotation", "genome", "repeated_role"),
    ],
)
def test_broken_bundles(spark, tmp_path, file, old, new, rule):
    p = bundle(tmp_path)
    text = open(p[file]).read()
    assert old in text
    write(tmp_path, p[file].rsplit("/", 1)[1], text.replace(old, new, 1))
    found = check_bundle(spark, p["samples"], p["runs"], p["references"], p["settings"], p["contrasts"])
    assert rule in {r["rule"] for r in found.collect()}
    with pytest.raises(checks.ContractError):
        checks.enforce(found)


def test_changed_reference_file(spark, tmp_path):
    p = bundle(tmp_path)
    write(tmp_path, "genome.txt", "other")
    found = check_bundle(spark, p["samples"], p["runs"], p["references"], p["settings"], p["contrasts"])
    assert {r["rule"] for r in found.collect()} == {"digest_differs"}


def test_reserved_names_and_read_stage(spark):
    samples = spark.createDataFrame([(1, "gene_id", "a", 1.0)], "record int, sample_id string, condition string, PC1 double")
    assert {r["rule"] for r in checks.reserved_violations(samples).collect()} == {"reserved_id", "reserved_covariate"}
    schema = "sampling string, read struct<run_id:string,selection:string>"
    good = spark.createDataFrame([(checks.PREFIX_SAMPLING + " more", ("r1", None))], schema)
    bad = spark.createDataFrame([("every fifth record", ("r1", None)), (checks.PREFIX_SAMPLING, ("r2", "0,5,10"))], schema)
    assert checks.read_stage_violations(good).count() == 0
    assert {r["rule"] for r in checks.read_stage_violations(bad).collect()} == {"not_a_prefix_stage", "non_prefix_selection"}


EXONS = [("A", "+", 101, 300), ("A", "+", 501, 700), ("B", "-", 1001, 1300), ("C", "+", 1101, 1400), ("zero", "+", 2001, 2300)]
ORIGINS = {"exon_plus": ("151-225", "+"), "junction": ("264-300,501-538", "+"), "exon_minus": ("1001-1075", "-"), "both": ("1151-1225", "+")}


def aligned(spark, rows):
    frame = spark.createDataFrame(rows, "read_id string, chrom string, strand string, mate int, nh int, unmapped boolean, i string")
    return frame.withColumn("blocks", seq.parse_intervals(F.col("i"))).drop("i")


def exon_frame(spark):
    return spark.createDataFrame([(g, "c", s, a, b) for g, s, a, b in EXONS], "gene_id string, chrom string, strand string, start int, end int")


@pytest.mark.parametrize("ranges", [overlap.RANGES, 1, 3])
def test_read_origins_give_known_genes(spark, ranges):
    rows = [(n, "c", s, 0, 1, False, i) for n, (i, s) in ORIGINS.items()]
    got = overlap.assign(aligned(spark, rows), exon_frame(spark), ranges=ranges)
    assert {r["fragment_id"]: (r["status"], r["gene_id"]) for r in got.collect()} == {
        "exon_plus": ("Assigned", "A"), "junction": ("Assigned", "A"), "exon_minus": ("Assigned", "B"), "both": ("Unassigned_Ambiguity", None)}
    universe = exon_frame(spark).select("gene_id").distinct()
    zeros = overlap.with_zero_genes(overlap.gene_counts(got), universe)
    assert {r["gene_id"]: r["count"] for r in zeros.collect()} == {"A": 2, "B": 1, "C": 0, "zero": 0}


def test_pairs_strands_and_multimapping(spark):
    pair = [("f/1", "c", "+", 1, 1, False, "151-225"), ("f/2", "c", "-", 2, 1, False, "576-650")]
    more = [("m", "c", "+", 0, 3, False, "151-225"), ("u", None, "+", 0, None, True, None), ("n", "c", "+", 0, 1, False, "401-450")]
    def state(strandedness):
        got = overlap.assign(aligned(spark, pair + more), exon_frame(spark), strandedness)
        return {r["fragment_id"]: r["status"] for r in got.collect()}

    assert state("unstranded") == {"f": "Assigned", "m": "Unassigned_MultiMapping", "u": "Unassigned_Unmapped", "n": "Unassigned_NoFeatures"}
    assert state("forward")["f"] == "Assigned" and state("reverse")["f"] == "Unassigned_NoFeatures"


def check_overlap(spark, rows, exons, **how):
    frame = spark.createDataFrame(exons, "gene_id string, chrom string, strand string, start int, end int")
    got = {r["fragment_id"]: (r["status"], r["gene_id"]) for r in overlap.assign(aligned(spark, rows), frame, **how).collect()}
    assert len(got) == len(rows)
    for name, chrom, strand, _, _, _, text in rows:
        s, e = map(int, text.split("-"))
        hits = {g for g, c, t, a, b in exons if c == chrom and s <= b and a <= e and (how.get("strandedness") != "forward" or t == strand)}
        want = ("Unassigned_NoFeatures", None) if not hits else ("Assigned", hits.pop()) if len(hits) == 1 else ("Unassigned_Ambiguity", None)
        assert got[name] == want


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_overlap_matches_brute_force_when_one_place_is_hot(spark, ranges):
    rng = np.random.default_rng(1)
    starts = np.where(rng.random(600) < 0.4, 500, rng.integers(1, 20000, 600))
    rows = [(f"r{i}", "cd"[i % 2], "+-"[i % 3 % 2], 0, 1, False, f"{s}-{s + int(rng.integers(1, 400))}") for i, s in enumerate(starts)]
    exons = [(f"g{i}", "cd"[i % 2], "+-"[i % 5 % 2], int(s), int(s) + int(rng.integers(1, 3000))) for i, s in enumerate(rng.integers(1, 20000, 60))]
    check_overlap(spark, rows, exons, ranges=ranges)
    check_overlap(spark, rows, exons, ranges=ranges, strandedness="forward")


def test_overlap_where_exons_crowd_and_long_ones_stay_open(spark, monkeypatch):
    monkeypatch.setattr(overlap, "CANDIDATES", 64)
    rng = np.random.default_rng(2)
    # Half of all exons begin at one place, three span everything, and reads lie on borders of length one.
    exons = [(f"g{i}", "c", "+", 700, 700 + int(rng.integers(0, 50))) for i in range(200)]
    exons += [(f"far{i}", "c", "+", 1 + i, 100_000) for i in range(3)]
    exons += [(f"s{i}", "c", "+", 3000 + 40 * i, 3010 + 40 * i) for i in range(150)]
    rows = [(f"r{i}", "c", "+", 0, 1, False, f"{s}-{s + int(rng.integers(0, 30))}") for i, s in enumerate(rng.integers(650, 9500, 300))]
    check_overlap(spark, rows, exons, ranges=16)
    check_overlap(spark, rows, exons[203:], ranges=16)
    check_overlap(spark, rows[:5], [("only", "other", "+", 1, 10)], ranges=4)


def test_reads_equal_spliced_reference(spark, tmp_path):
    rng = np.random.default_rng(3)
    bases = "".join(rng.choice(list("ACGT"), 3000))
    text = ">c\n" + "".join(bases[i: i + 60] + "\n" for i in range(0, 3000, 60))
    chunks = overlap.reference_chunks(records.read_fasta(spark, write(tmp_path, "r.fa", text)))
    rows = [(n, "c", i, s) for n, (i, s) in ORIGINS.items()] + [("long", "c", "1-3000", "+")]
    origins = spark.createDataFrame(rows, "read_id string, chrom string, i string, orientation string").withColumn("intervals", seq.parse_intervals(F.col("i")))
    got = {r["read_id"]: r["expected"] for r in overlap.spliced_sequence(origins, chunks).collect()}
    flip = str.maketrans("ACGT", "TGCA")
    for name, _, intervals, strand in rows:
        whole = "".join(bases[int(a) - 1: int(b)] for a, b in (x.split("-") for x in intervals.split(",")))
        assert got[name] == (whole.translate(flip)[::-1] if strand == "-" else whole)


def brute_bh(p):
    order = np.argsort(p)
    steps = len(p) * p[order] / np.arange(1, len(p) + 1)
    out = np.empty(len(p))
    out[order] = np.minimum(1, np.minimum.accumulate(steps[::-1])[::-1])
    return out


@pytest.mark.parametrize("rows_per_range", [10**6, 25])
def test_adjusted_p_and_quantiles_match_brute_force(spark, rows_per_range):
    rng = np.random.default_rng(5)
    p = np.where(rng.random(900) < 0.33, 0.25, np.round(rng.random(900) ** 3, 3))
    group = np.where(rng.random(900) < 0.8, "hot", "cold")
    rows = [(i, str(g), None if i % 50 == 0 else float(v)) for i, (g, v) in enumerate(zip(group, p))]
    frame = spark.createDataFrame(rows, "i int, g string, p double")
    got = {r["i"]: r["padj"] for r in adjust_p(frame, "p", ["g"], rows_per_range=rows_per_range).collect()}
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    q = {(r["g"], r["level"]): r["quantile"] for r in exact_quantiles(frame, "p", probs, ["g"], rows_per_range=rows_per_range).collect()}
    hits = {r["g"]: r["rejections"] for r in rejections(frame, "p", ["g"], 0.05).collect()}
    for g in ("hot", "cold"):
        own = [(i, v) for i, name, v in rows if name == g and v is not None]
        want = brute_bh(np.array([v for _, v in own]))
        assert np.allclose([got[i] for i, _ in own], want, rtol=1e-12, atol=0)
        assert hits[g] == (want < 0.05).sum()
        assert np.allclose([q[g, k] for k in range(5)], np.quantile([v for _, v in own], probs), rtol=1e-12)
    assert all(got[i] is None for i, _, v in rows if v is None)
    counted = ordered_counts(frame, "p", ["g"], rows_per_range).filter("p = 0.25 AND g = 'hot'").first()
    own = [v for _, g, v in rows if g == "hot" and v is not None]
    assert counted["n"] == sum(v == 0.25 for v in own) and counted["upto"] == sum(v <= 0.25 for v in own) and counted["total"] == len(own)


@pytest.mark.parametrize(
    "kind, values",
    [
        ("bigint", [2**53 + i for i in (3, 1, 1, 2, 0)] + [None, -5]),
        ("decimal(20,0)", ["18446744073709551615", "18446744073709551614", "0", None, "0"]),
        ("string", ["b", "a", "ab", None, "", "a", "é"]),
        ("double", [0.5, float("nan"), None, -0.0, 0.0, float("inf"), 0.5]),
    ],
)
def test_ranks_do_not_depend_on_range_size_or_type(spark, kind, values):
    rows = [(g, None if v is None else str(v)) for g in ("x", None) for v in values]
    frame = spark.createDataFrame(rows, "g string, s string").select("g", F.col("s").cast(kind).alias("v"))
    tables = [ordered_counts(frame, "v", ["g"], n).drop("value_range") for n in (1, 2, 10**6)]
    assert all(dict(t.dtypes)["v"] == kind for t in tables)
    rows = [sorted(map(repr, t.collect())) for t in tables]
    assert rows[0] == rows[1] == rows[2]
    known = [v for v in values if v is not None and v == v]
    for r in tables[0].collect():
        assert r["total"] == len(known) and r["n"] == sum(str(v) == str(r["v"]) or v == r["v"] for v in known)
    if kind == "double":
        assert adjust_p(frame, "v", ["g"]).filter("isnan(v) AND padj IS NOT NULL").count() == 0


def test_correlation_guards_and_sets(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert flat.agg(compare.pearson("a", "b")).first()[0] is None
    empty = spark.createDataFrame([], "gene_id string")
    assert compare.set_overlap(empty, empty).first()["jaccard"] is None
    cells = compare.join_cells(
        spark.createDataFrame([("g", "s", 1)], "gene_id string, sample_id string, count int"),
        spark.createDataFrame([("g", "t", 1)], "gene_id string, sample_id string, count int"),
    )
    assert compare.unmatched_cells(cells).count() == 2
    files = spark.createDataFrame([("run1/a", 3), ("run1/b/c", 4), ("run2/a", 5)], "path string, bytes int")
    assert {r["run"]: r["bytes"] for r in compare.bytes_per_run(files).collect()} == {"run1": 7, "run2": 5}


def test_log_parity(spark):
    schema = "k string, p double"
    a = spark.createDataFrame([("x", 1e-300), ("y", 0.0), ("z", None)], schema)
    b = spark.createDataFrame([("x", 1.1e-300), ("y", 1e-320), ("z", None)], schema)
    assert compare.parity(a, b, ["k"]).count() == 0
    assert {(r["k"], r["problem"]) for r in compare.parity(a, b, ["k"], ("p",)).collect()} == {("x", "log_number"), ("y", "zero_mask")}


def test_ordered_lookup_keeps_unmapped(spark):
    samples = spark.createDataFrame([(1, "b"), (2, "a")], "ordinal int, sample_id string")
    mapping = spark.createDataFrame([("a", "r1")], "sample_id string, run_id string")
    rows = cohort.lookup_in_order(samples, mapping).orderBy("ordinal").collect()
    assert [(r["sample_id"], r["run_id"]) for r in rows] == [("b", None), ("a", "r1")]


def test_workspace_tables_live_in_the_shared_folder(spark):
    ws = Workspace(spark, "test")
    assert ws.path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert ws.save(spark.range(3), "t").count() == 3


def test_counts_of_unlisted_samples_are_refused(spark):
    matrix = spark.createDataFrame([("g", "a", 1), ("g", "stranger", 5)], "gene_id string, sample_id string, count long")
    for made in (counts.to_wide, counts.dense):
        assert made(matrix, ["a", "stranger"]).count() > 0
        with pytest.raises(Exception, match="stranger"):
            made(matrix, ["a"]).collect()


def test_every_two_tables_side_by_side(spark):
    from exprspark.stats import results as res

    nan = float("nan")
    rows = [
        ("x", "g1", 2.0, 0.01), ("y", "g1", -1.0, 0.02), ("z", "g1", 0.0, 0.9),
        ("x", "g2", 1.0, 0.04), ("y", "g2", nan, 0.03), ("z", "g3", 3.0, None),
        ("y", "g4", 1.5, nan), ("x", "g4", 1.0, 0.5), ("other", "g5", 1.0, 0.01), (None, "g6", 1.0, 0.01),
    ]
    table = spark.createDataFrame(rows, "backend string, gene_id string, log2FoldChange double, padj double")
    names = ["x", "y", "z"]
    genes = compare.paired_results(table, names)
    assert genes.count() == 12
    by = ["backend_a", "backend_b"]
    report = {(r["backend_a"], r["backend_b"]): r for r in compare.compare_pairs(genes, by).collect()}
    sets = {(r["backend_a"], r["backend_b"]): r for r in compare.overlap_of_pairs(genes, by).collect()}
    assert set(report) == set(sets) == {("x", "y"), ("x", "z"), ("y", "z")}
    for (a, b), got in report.items():
        one = [table.filter(F.col("backend") == n).drop("backend") for n in (a, b)]
        alone = compare.compare_results(*one).first().asDict()
        assert {k: got[k] for k in alone} == alone
        overlap = compare.set_overlap(*[compare.significant_genes(t) for t in one]).first().asDict()
        assert {k: sets[a, b][k] for k in overlap} == overlap
        state = {(r["gene_id"], r["state"]) for r in cohort.novel_and_absent(*[compare.significant_genes(t) for t in one]).collect()}
        mine = genes.filter((F.col("backend_a") == a) & (F.col("backend_b") == b) & (F.col("in_a") != F.col("in_b"))).collect()
        assert state == {(r["gene_id"], "novel" if r["in_a"] else "absent") for r in mine}
        same = cohort.same_set(*one, ["gene_id"]).first().asDict()
        every = cohort.same_sets(table, names, ["gene_id"]).filter((F.col("backend_a") == a) & (F.col("backend_b") == b)).first()
        assert {k: every[k] for k in same} == same
    assert report["x", "y"]["common_genes"] == 2 and report["x", "y"]["sign_disagreements"] == 1
    assert report["x", "y"]["median_absolute_difference"] == 1.75 and report["x", "y"]["n_both"] == 2
    empty = table.limit(0)
    assert compare.compare_pairs(compare.paired_results(empty, names), by).count() == 0
    assert compare.compare_results(empty.drop("backend"), empty.drop("backend")).first()["common_genes"] == 0
    lists = res.contrast_summary(table, {"alpha": "0.05"}, 0.05, ["backend"]).filter("key = 'significant'").collect()
    assert {r["backend"]: r["value"] for r in lists} == {"x": "2", "y": "2", "z": "0", "other": "1", None: "1"}
    values = spark.createDataFrame([("g1", "s", 1.0), ("g2", "s", 2.0)], "gene_id string, sample_id string, value double")
    picked = res.heatmap(table, values, 0.05, ["backend"]).collect()
    assert {(r["backend"], r["gene_id"], r["rank"]) for r in picked} == {("x", "g1", 1), ("x", "g2", 2), ("y", "g1", 1), ("y", "g2", 2)}


def test_cohort_matrix_and_unmatched_samples(spark):
    cells = spark.createDataFrame(
        [(1, "g1", "c1", "3"), (1, "g1", "c2", "-1"), (2, "g2", "c1", "2147483647"), (2, "g2", "c2", "2147483648"), (3, "g1", "c1", None), (3, "g1", "c3", "0")],
        "record int, gene_id string, count_column string, count string",
    )
    samples = spark.createDataFrame([("c1", "control"), ("c2", None), ("c4", "control")], "count_column string, condition string")
    found = {(r["record"], r["column"], r["rule"]) for r in checks.cohort_matrix_violations(cells, samples, ("control", "case")).collect()}
    assert found == {
        (1, "c3", "unknown_count_column"), (1, "c4", "missing_count_column"), (3, "gene_id", "repeated_gene"),
        (1, "c2", "not_a_count"), (3, "c1", "not_a_count"), (2, "c2", "beyond_int32"), (1, "case", "missing_condition"),
    }
    empty = checks.cohort_matrix_violations(cells.limit(0), samples.limit(0), ("control", "case"))
    assert empty.count() == 0
    entries = spark.createDataFrame([("s1", "t", "c1", "x1"), ("s2", "t", "c2", "x2")], "sample_id string, title string, count_column string, experiment string")
    runs = spark.createDataFrame([("r1", "x1", "SINGLE")], "run_accession string, experiment_accession string, library_layout string")
    assert cohort.sample_run_mapping(entries.filter("sample_id = 's1'"), runs, "reverse").first()["run_id"] == "r1"
    with pytest.raises(Exception, match="sample without a run: s2"):
        cohort.sample_run_mapping(entries, runs, "reverse").collect()
