"""Variance stabilization, sample PCA and sample distances over packed gene rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.operators.ordering import exact_quantiles
from exprspark.session import Workspace
from exprspark.stats.fit import Fit, Trend
from exprspark.stats.normalize import vst_parametric

GRID_POINTS = 1000
TILE = 32
HELD_VALUES = 1 << 22
BLOCK = 8


def normalized_arrays(genes: DataFrame, sf: np.ndarray) -> DataFrame:
    factors = F.array(*[F.lit(float(v)) for v in sf])
    return genes.select("gene_id", F.zip_with("y", factors, lambda c, s: c / s).alias("x"))


def vst_arrays(fit: Fit) -> DataFrame:
    """``(gene_id, x)`` with the variance-stabilized values in sample order."""
    values = normalized_arrays(fit.genes, fit.size_factors)
    if fit.trend.parametric:
        a0, a1 = fit.trend.a0, fit.trend.a1
        return values.select("gene_id", F.transform("x", lambda q: vst_parametric(q, a0, a1)).alias("x"))
    return vst_local(values, fit.trend, fit.size_factors)


def vst_local(values: DataFrame, trend: Trend, sf: np.ndarray) -> DataFrame:
    """Without a closed form: integrate 1/sd over an even asinh grid, then match log2 at the top end."""
    top = values.agg(F.max(F.array_max("x"))).first()[0]
    means = values.select((F.aggregate("x", F.lit(0.0), lambda a, b: a + b) / F.size("x")).alias("mean"))
    low, high = (r["quantile"] for r in exact_quantiles(means, "mean", [0.5, 0.95]).orderBy("level").collect())
    at = np.sinh(np.linspace(0, np.arcsinh(max(top, 1.0)), GRID_POINTS))[1:]
    step = np.diff(np.concatenate([[0.0], at]))
    middle = at - step / 2
    raw = trend(np.maximum(middle, np.exp(trend.log_mean[0])))
    variance = middle * np.mean(1.0 / sf) + raw * middle**2
    curve = np.concatenate([[0.0], np.cumsum(step / np.sqrt(variance))])
    knots = np.concatenate([[0.0], at])
    a, b = np.interp([low, high], knots, curve)
    slope = (np.log2(high) - np.log2(low)) / (b - a) if b > a else 1.0
    offset = np.log2(high) - slope * b
    knots_asinh = np.arcsinh(knots)

    def run(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            if len(table):
                cells = np.stack(table["x"].to_numpy())
                stable = slope * np.interp(np.arcsinh(cells), knots_asinh, curve) + offset
                yield pd.DataFrame({"gene_id": table["gene_id"], "x": list(stable)})

    return values.mapInPandas(run, "gene_id string, x array<double>")


def unpack(arrays: DataFrame, samples: list[str], name: str = "value") -> DataFrame:
    """Packed rows as ``(gene_id, sample_id, value)``."""
    ids = F.array(*[F.lit(s) for s in samples])
    pairs = F.explode(F.arrays_zip(ids.alias("sample_id"), F.col("x").alias("v"))).alias("c")
    return arrays.select("gene_id", pairs).select("gene_id", "c.sample_id", F.col("c.v").alias(name))


def packed_rows(batch: pa.RecordBatch, centered: bool) -> np.ndarray:
    """The arrays of a batch as a matrix of genes x samples, each gene's mean taken off if ``centered``."""
    lists = batch.column(0)
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)
    return x - x.mean(axis=1, keepdims=True) if centered else x


def gram(arrays: DataFrame, centered: bool = True, tile: int = TILE, held_values: int = HELD_VALUES) -> DataFrame:
    """Sums of products of sample pairs over all genes: ``(i, j, g)`` for ``i <= j``.

    A task gathers genes up to a bounded number of values and multiplies them tile by tile: one tile is all samples
    against ``tile`` samples, sent on as one row per sample before the next is made. So neither a task nor the driver
    holds samples x samples numbers, a gene never fans out into its pairs, and the wider the cohort, the fewer genes
    stand behind a tile. Tiles are added up by sample and tile.
    """
    columns = [f"c{k}" for k in range(tile)]

    def tiles(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x = np.concatenate(parts)
        n = x.shape[1]
        for first in range(0, n, tile):
            rows = min(n, first + tile)
            values = np.zeros((rows, tile))
            values[:, : rows - first] = x[:, :rows].T @ x[:, first:rows]
            head = [pa.array(np.arange(rows, dtype=np.int32)), pa.array(np.full(rows, first, dtype=np.int32))]
            yield pa.RecordBatch.from_arrays(head + [pa.array(np.ascontiguousarray(c)) for c in values.T], names=["i", "first", *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                held.append(packed_rows(batch, centered))
                if sum(x.size for x in held) >= held_values:
                    yield from tiles(held)
                    held = []
        if held:
            yield from tiles(held)

    partial = arrays.select("x").mapInArrow(run, ", ".join(["i int", "first int", *[f"{c} double" for c in columns]]))
    summed = partial.groupBy("i", "first").agg(*[F.sum(c).alias(c) for c in columns])
    # A tile is padded beyond the last sample; those columns have no row of their own.
    cells = summed.select("i", "first", F.posexplode(F.array(*columns)).alias("at", "g")).select("i", (F.col("first") + F.col("at")).alias("j"), "g")
    width = summed.agg((F.max("i") + 1).alias("width"))
    return cells.join(F.broadcast(width), F.col("j") < F.col("width")).filter("i <= j").select("i", "j", "g")


def products(arrays: DataFrame, q: np.ndarray) -> tuple[np.ndarray, float]:
    """``X'X q`` for the gene-centered rows ``X``, and the sum of their squares.

    A task keeps one matrix of the shape of ``q``, samples x a few columns; so does the driver.
    """
    columns = [f"c{k}" for k in range(q.shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = np.zeros(q.shape), 0.0
        for batch in batches:
            if batch.num_rows:
                x = packed_rows(batch, True)
                total += x.T @ (x @ q)
                squares += float((x * x).sum())
        head = [pa.array(np.arange(len(q), dtype=np.int32)), pa.array(np.where(np.arange(len(q)) == 0, squares, 0.0))]
        yield pa.RecordBatch.from_arrays(head + [pa.array(np.ascontiguousarray(c)) for c in total.T], names=["i", "squares", *columns])

    schema = ", ".join(["i int", "squares double", *[f"{c} double" for c in columns]])
    partial = arrays.select("x").mapInArrow(run, schema)
    found = partial.groupBy("i").agg(F.sum("squares").alias("squares"), *[F.sum(c).alias(c) for c in columns]).toArrow().sort_by("i")
    if not found.num_rows:
        return np.zeros(q.shape), 0.0
    return np.column_stack([found[c].to_numpy() for c in columns]), float(found["squares"].to_numpy().sum())


def orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the block adds to the basis; directions within rounding of it are left out."""
    scale = np.linalg.norm(block, axis=0).max(initial=0.0)
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    q, r = np.linalg.qr(block)
    q = q[:, np.abs(np.diag(r)) > 1e-10 * scale] if scale > 0 else q[:, :0]
    q = q - basis @ (basis.T @ q)
    return np.linalg.qr(q)[0][:, : len(block) - basis.shape[1]] if q.shape[1] else q


def principal_components(
    arrays: DataFrame, samples: int, components: int = 2, block: int = BLOCK, tolerance: float = 1e-11, passes: int = 60
) -> tuple[np.ndarray, np.ndarray]:
    """Sample scores of the first principal components of packed gene rows, and their shares of variance.

    Block power iteration: each pass over the genes multiplies a few directions by ``X'X``. The directions of all passes
    together span the subspace in which the components are sought (Rayleigh-Ritz), so that close eigenvalues need few
    passes; with as many directions as samples it is exact. Ends when the residuals are below ``tolerance`` of the first
    eigenvalue. The driver holds samples x directions numbers, never samples x samples for a wide cohort. ``arrays`` is
    read once a pass and should be a written table. The sign of a component makes its largest score positive; components
    without variance have zero scores.
    """
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((samples, min(samples, block))))[0]
    basis = images = np.zeros((samples, 0))
    for _ in range(passes):
        y, total = products(arrays, q)
        basis, images = np.hstack([basis, q]), np.hstack([images, y])
        inner = basis.T @ images
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        found = basis @ vectors
        left = np.linalg.norm(images @ vectors - found * values, axis=0)
        if basis.shape[1] >= samples or left.max() <= tolerance * max(values[0], 1e-300):
            break
        q = orthonormal(y, basis)
        if not q.shape[1]:
            break
    else:
        raise ArithmeticError(f"principal components did not settle in {passes} passes")
    scores, share = np.zeros((samples, components)), np.zeros(components)
    for c in range(len(values)):
        # What is left of a component without variance is rounding.
        if total > 0 and values[c] > 1e-14 * total:
            score = found[:, c] * np.sqrt(values[c])
            scores[:, c] = score * (np.sign(score[np.argmax(np.abs(score))]) or 1.0)
            share[c] = values[c] / total
    return scores, share


def distances_of(grams: DataFrame) -> DataFrame:
    """Pair distances ``(i, j, distance)`` from Gram rows, ``i <= j``."""
    diagonal = grams.filter("i = j").select(F.col("i").alias("k"), F.col("g").alias("norm"))
    a = diagonal.select(F.col("k").alias("i"), F.col("norm").alias("gi"))
    b = diagonal.select(F.col("k").alias("j"), F.col("norm").alias("gj"))
    squared: Column = F.greatest(F.col("gi") + F.col("gj") - 2 * F.col("g"), F.lit(0.0))
    return grams.join(a, "i").join(b, "j").select("i", "j", F.sqrt(squared).alias("distance"))


def sample_distances(arrays: DataFrame, samples: DataFrame) -> DataFrame:
    """``sample_a, sample_b, distance`` of all ordered pairs; ``samples`` has ``at, sample_id`` in the order of the arrays."""
    grams = Workspace(arrays.sparkSession, "distances").save(gram(arrays), "gram")
    one, other = F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b"))
    ways = F.when(F.col("i") < F.col("j"), F.array(one, other)).otherwise(F.array(one))
    both = distances_of(grams).select(F.inline(ways), "distance")
    a = samples.select(F.col("at").alias("a"), F.col("sample_id").alias("sample_a"))
    b = samples.select(F.col("at").alias("b"), F.col("sample_id").alias("sample_b"))
    return both.join(a, "a").join(b, "b").select("sample_a", "sample_b", "distance")
