"""Bounded samples of labelled documents to fit models on, and the split that is held out of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column | None = None) -> Column:
    """Whether a row's label is kept from training: the CRC-32 of its id as text leaves no remainder by five."""
    column = F.col("doc_id") if doc_id is None else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents outside the held-out fold, chosen by a hash of their id.

    The chosen ids are a top-``rows`` list, so the side that is broadcast has a proven bound and texts stay where they
    are. An id with several labels counts once, with the largest; rows without id or label play no part.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    one = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")


def logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 1.0, steps: int = 60) -> np.ndarray:
    """Coefficients of a ridge-penalised logistic fit by Newton steps; the last column of features is the constant."""
    n, k = features.shape
    coef = np.zeros(k)
    ridge = np.full(k, penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(features @ coef)
        gradient = features.T @ (labels - p) - ridge * coef
        weight = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve(features.T @ (features * weight[:, None]) + np.diag(ridge), gradient)
        size = np.abs(step).max()
        coef += step * min(1.0, 4.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return coef


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))
