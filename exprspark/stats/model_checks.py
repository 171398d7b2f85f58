"""Design matrices and model checks of many studies at once, as tables; a broken model is a row, not an exception."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from exprspark.functions.text import syntactic_name

MODEL = ["study", "contrast_id"]
INTERCEPT = "(Intercept)"
# A column that keeps less than this part of its length beside the ones before it depends on them.
RANK_TOLERANCE = 1e-7


def term_levels(values: DataFrame, terms: DataFrame) -> DataFrame:
    """Observed levels of the categorical terms of each model, the reference first (number 0), the rest in byte order.

    ``values(study, sample_id, term, value)``, ``terms(study, contrast_id, term_no, term, kind, reference)``; without a
    reference the first level in byte order takes its place.
    """
    seen = values.filter("value IS NOT NULL").select("study", "term", "value").distinct()
    levels = terms.filter("kind = 'categorical'").join(seen, ["study", "term"])
    first = F.coalesce(F.col("value") != F.col("reference"), F.lit(False))
    order = Window.partitionBy(*MODEL, "term").orderBy(first, F.encode("value", "utf-8"))
    return levels.withColumn("level_no", F.row_number().over(order) - 1)


def design_columns(values: DataFrame, terms: DataFrame) -> DataFrame:
    """``study, contrast_id, col_no, name, term, level``: intercept, a column per level but the reference, numeric terms."""
    levels = term_levels(values, terms).filter("level_no > 0")
    none = F.lit(None).cast("string")
    start = terms.select(*MODEL).distinct().select(
        *MODEL, F.lit(-1).alias("term_no"), F.lit(0).alias("level_no"), F.lit(INTERCEPT).alias("name"), none.alias("term"), none.alias("level")
    )
    dummies = levels.select(*MODEL, "term_no", "level_no", F.concat("term", "value").alias("name"), "term", F.col("value").alias("level"))
    numeric = terms.filter("kind = 'numeric'").select(*MODEL, "term_no", F.lit(1).alias("level_no"), F.col("term").alias("name"), "term", none.alias("level"))
    order = Window.partitionBy(*MODEL).orderBy("term_no", "level_no")
    all_columns = start.unionByName(dummies).unionByName(numeric)
    return all_columns.select(*MODEL, (F.row_number().over(order) - 1).alias("col_no"), "name", "term", "level")


def design_cells(values: DataFrame, columns: DataFrame) -> DataFrame:
    """The design matrices in long form: ``study, contrast_id, sample_id, col_no, name, value``."""
    samples = values.select("study", "sample_id").distinct()
    known = values.select("study", "sample_id", "term", F.col("value").alias("said"))
    cells = columns.join(samples, "study").join(known, ["study", "sample_id", "term"], "left")
    dummy = F.coalesce(F.col("said") == F.col("level"), F.lit(False)).cast("double")
    value = F.when(F.col("term").isNull(), 1.0).when(F.col("level").isNotNull(), dummy).otherwise(F.col("said").try_cast("double"))
    return cells.select(*MODEL, "sample_id", "col_no", "name", value.alias("value"))


def rank_of(x: np.ndarray) -> int:
    """Columns left by elimination with pivoting: each step takes the column that kept the largest part of its length."""
    left = x.astype(float).copy()
    lengths = np.linalg.norm(x, axis=0)
    open_columns = np.flatnonzero(lengths > 0)
    rank = 0
    while len(open_columns):
        kept = np.linalg.norm(left[:, open_columns], axis=0) / lengths[open_columns]
        best = int(np.argmax(kept))
        if kept[best] <= RANK_TOLERANCE:
            break
        direction = left[:, open_columns[best]]
        direction = direction / np.linalg.norm(direction)
        open_columns = np.delete(open_columns, best)
        left[:, open_columns] -= np.outer(direction, direction @ left[:, open_columns])
        rank += 1
    return rank


def design_ranks(cells: DataFrame) -> DataFrame:
    """``study, contrast_id, samples, columns, broken, rank`` per model; a model with a value that is no number has no rank.

    A model's rows are packed into arrays and eliminated in one task, which holds samples x columns numbers.
    """
    packed = cells.groupBy(*MODEL, "sample_id").agg(F.array_sort(F.collect_list(F.struct("col_no", F.coalesce("value", F.lit(float("nan"))).alias("v")))).alias("cells"))
    packed = packed.select(*MODEL, F.transform("cells", lambda c: c["v"]).alias("x"))

    def run(table: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(table["x"].to_numpy())
        broken = not np.isfinite(x).all()
        head = {c: [table[c].iloc[0]] for c in MODEL}
        return pd.DataFrame({**head, "samples": [len(x)], "columns": [x.shape[1]], "broken": [broken], "rank": [None if broken else rank_of(x)]})

    kinds = dict(cells.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in MODEL] + ["samples int", "columns int", "broken boolean", "rank int"])
    return packed.groupBy(*MODEL).applyInPandas(run, schema)


def repeated_names(names: DataFrame, by: list[str], name: Column) -> DataFrame:
    """The groups in which two names are the same once they are made syntactic."""
    tally = names.select(*by, syntactic_name(name).alias("plain")).groupBy(*by).agg(F.count("plain").alias("n"), F.countDistinct("plain").alias("different"))
    return tally.filter("n > different").select(*by)


def model_violations(values: DataFrame, terms: DataFrame, contrasts: DataFrame) -> DataFrame:
    """``study, contrast_id, rule, subject``: what keeps a model from being fitted; none means that all can be.

    ``contrasts(study, contrast_id, factor, numerator)``. Every rule is checked by itself: a categorical term needs two
    levels whose names stay apart, numeric terms numbers, the matrix full rank and more samples than columns, column names
    must stay apart and none may be ``sample_id``, and the numerator must have a column.
    """
    levels = term_levels(values, terms)
    columns = design_columns(values, terms)
    ranks = design_ranks(design_cells(values, columns))

    def found(rows: DataFrame, rule: str, subject: Column) -> DataFrame:
        return rows.select(*MODEL, F.lit(rule).alias("rule"), subject.alias("subject"))

    categorical = terms.filter("kind = 'categorical'").select(*MODEL, "term")
    counted = levels.groupBy(*MODEL, "term").agg(F.count(F.lit(1)).alias("n"))
    few = categorical.join(counted, [*MODEL, "term"], "left").filter("coalesce(n, 0) < 2")
    numbers = terms.filter("kind = 'numeric'").join(values, ["study", "term"])
    number = F.col("value").try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    term, nothing = F.col("term"), F.lit("")
    asked = contrasts.join(columns.select(*MODEL, F.col("term").alias("factor"), F.col("level").alias("numerator"), F.lit(1).alias("there")),
                           [*MODEL, "factor", "numerator"], "left")
    parts = [
        found(few, "few_levels", term),
        found(repeated_names(levels, [*MODEL, "term"], F.col("value")), "colliding_levels", term),
        found(numbers.filter(~F.coalesce(finite, F.lit(False))).select(*MODEL, "term").distinct(), "not_a_number", term),
        found(ranks.filter("rank < columns"), "rank_deficient", nothing),
        found(ranks.filter("samples <= columns"), "no_residual_df", nothing),
        found(repeated_names(columns, MODEL, F.col("name")), "ambiguous_names", nothing),
        found(columns.filter("name = 'sample_id'"), "reserved_name", F.col("name")),
        found(asked.filter("there IS NULL"), "no_coefficient", F.col("numerator")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
