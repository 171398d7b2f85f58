"""Whole-run parity, model checks as rows, and proven row order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from exprspark.operators import compare
from exprspark.operators.ordering import global_positions
from exprspark.stats import model_checks


def test_run_parity_names_every_kind_of_difference(spark):
    schema = "gene_id string, n int, x double, tags array<string>, only_{} string"
    e = spark.createDataFrame([("a", 1, 1.0, ["u"], "k"), ("b", 2, None, ["v"], "k"), ("c", 3, 3.0, None, "k"), ("d", 4, float("nan"), [], "k"),
                               ("e", 5, float("inf"), [], "k"), (None, 6, 0.0, [], "k")], schema.format("here"))
    x = spark.createDataFrame([("a", 1, 1.0 + 1e-9, ["w"], "k"), ("b", 2, 2.0, ["v"], "k"), ("c", 4, 3.1, None, "k"), ("e", 5, float("inf"), [], "k"),
                               ("f", 7, 0.0, [], "k"), (None, 6, 1e-11, [], "k")], schema.format("there"))
    text = x.select("gene_id", F.col("n").cast("string").alias("n"))
    books = spark.createDataFrame([("workers", "1"), ("alpha", None)], "key string, value string")
    other = spark.createDataFrame([("workers", "8"), ("alpha", None)], "key string, value string")
    found = compare.run_parity({"t": e, "kinds": x.select("gene_id", "n"), "books": books, "gone": e}, {"t": x, "kinds": text, "books": other, "new": e},
                               {"t": ["gene_id"], "kinds": ["gene_id"], "books": ["key"]}, {"key": ["workers"]})

    def row(gene):
        return '{"gene_id":"%s"}' % gene

    got = {tuple(r) for r in found.filter("table <> 'kinds'").collect()}
    assert got == {
        ("gone", None, None, "missing_table"), ("new", None, None, "extra_table"), ("t", None, "only_here", "missing_column"),
        ("t", None, "only_there", "extra_column"), ("t", row("a"), "tags", "value"), ("t", row("b"), "x", "null_mask"), ("t", row("c"), "n", "number"),
        ("t", row("c"), "x", "number"), ("t", row("d"), "*", "missing_row"), ("t", row("f"), "*", "extra_row")}
    assert {r["problem"] for r in found.filter("table = 'kinds'").collect()} == {"kind"}
    same = compare.run_parity({"t": e}, {"t": e}, {"t": ["gene_id"]})
    assert same.count() == 0
    assert compare.run_parity({"t": e.limit(0)}, {"t": e.limit(0)}, {"t": ["gene_id"]}).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_rank_by_elimination(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 2, (12, 5)).astype(float)
    x[:, 1] *= 1e9
    x = np.column_stack([x, x[:, 0] + x[:, 2], np.zeros(12), 1e-9 * rng.normal(size=12)])
    scaled = x / np.maximum(np.linalg.norm(x, axis=0), 1e-300)
    assert model_checks.rank_of(x) == np.linalg.matrix_rank(scaled, tol=1e-6)
    assert model_checks.rank_of(np.zeros((3, 2))) == 0 and model_checks.rank_of(np.ones((2, 4))) == 1


def studies(spark, data, terms, contrasts):
    values = [(study, f"s{i}", term, v) for study, columns in data.items() for term, said in columns.items() for i, v in enumerate(said)]
    return (
        spark.createDataFrame(values, "study string, sample_id string, term string, value string"),
        spark.createDataFrame(terms, "study string, contrast_id string, term_no int, term string, kind string, reference string"),
        spark.createDataFrame(contrasts, "study string, contrast_id string, factor string, numerator string"),
    )


def test_model_violations_are_rows(spark):
    data = {
        "fine": {"batch": list("AABB"), "condition": ["t", "c", "t", "c"]},
        "confounded": {"batch": list("AABB") * 2, "condition": list("ccttcctt")},
        "small": {"batch": list("AAB"), "condition": ["t", "c", "t"]},
        "number": {"dose": ["1", "NaN", "x", "4", "5"], "condition": list("ctctc")},
        "clash": {"batch": ["1-a", "1.a", "z", "z", "z", "z"], "condition": list("ctctct")},
        "single": {"batch": list("AAAA"), "condition": list("ctct")},
        "reserved": {"sample_id": ["1", "2", "3", "5"], "condition": list("cttc")},
    }
    terms = []
    for study, columns in data.items():
        for no, term in enumerate(columns):
            numeric = term in ("dose", "sample_id")
            terms.append((study, "one", no, term, "numeric" if numeric else "categorical", "c" if term == "condition" else None))
    contrasts = [(study, "one", "condition", "t") for study in data] + [("fine", "one", "condition", "absent")]
    got = {tuple(r) for r in model_checks.model_violations(*studies(spark, data, terms, contrasts)).collect()}
    assert got == {
        ("confounded", "one", "rank_deficient", ""), ("small", "one", "no_residual_df", ""), ("number", "one", "not_a_number", "dose"),
        ("clash", "one", "colliding_levels", "batch"), ("single", "one", "few_levels", "batch"), ("reserved", "one", "reserved_name", "sample_id"),
        ("fine", "one", "no_coefficient", "absent")}
    values, wanted, asked = studies(spark, data, terms, contrasts)
    assert model_checks.model_violations(values.limit(0), wanted.limit(0), asked.limit(0)).count() == 0


def test_design_of_two_factors_and_a_number(spark):
    data = {"s": {"batch": ["B", "A", "é"], "dose": ["2", "0.5", "-1"]}}
    terms = [("s", "k", 2, "batch", "categorical", "B"), ("s", "k", 1, "dose", "numeric", None)]
    values, wanted, _ = studies(spark, data, terms, [("s", "k", "batch", "A")])
    columns = model_checks.design_columns(values, wanted)
    assert [r["name"] for r in columns.orderBy("col_no").collect()] == ["(Intercept)", "dose", "batchA", "batché"]
    cells = model_checks.design_cells(values, columns).orderBy("sample_id", "col_no").collect()
    assert [r["value"] for r in cells] == [1, 2, 0, 0, 1, 0.5, 1, 0, 1, -1, 0, 1]


def test_positions_follow_the_order_and_name_every_row(spark):
    rng = np.random.default_rng(5)
    rows = [(int(v), f"é{v}" if v % 2 else None, "mine") for v in rng.integers(0, 60, 500)]
    frame = spark.createDataFrame(rows, "v int, name string, part string").repartition(7)
    got = global_positions(frame, ["name", "v"], "at").orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(1, 501))
    assert [(r["name"], r["v"]) for r in got] == sorted([(n, v) for v, n, _ in rows], key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1]))
    assert got[0]["part"] == "mine" and global_positions(frame.limit(0), ["v"]).count() == 0
