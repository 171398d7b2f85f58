"""Design matrices, their checks, and which contrasts can share one fit.

A design has one row per sample, so it lives on the driver and travels with the task closures.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

from exprspark.operators.checks import ContractError


@dataclass
class Model:
    samples: list[str]
    matrix: np.ndarray
    names: list[str]
    coefficient: int
    coefficient_name: str
    levels: dict[str, list[str]]
    values: dict[str, list] = field(default_factory=dict)

    @property
    def residual_df(self) -> int:
        return self.matrix.shape[0] - self.matrix.shape[1]

    @property
    def cells(self) -> np.ndarray:
        return np.unique(self.matrix, axis=0, return_inverse=True)[1].ravel()

    def in_cells_of(self, n: int) -> np.ndarray:
        """Which samples share their design row with at least ``n`` samples, themselves included."""
        cells = self.cells
        return np.bincount(cells)[cells] >= n

    @property
    def two_groups_only(self) -> bool:
        return len(self.levels) == len(self.values) == 1 and all(len(v) == 2 for v in self.levels.values())

    def same_fit(self, other: "Model") -> bool:
        return (
            self.names == other.names
            and np.array_equal(self.matrix, other.matrix)
            and self.levels == other.levels
            and self.samples == other.samples
        )


def syntactic(name: str) -> str:
    dotted = re.sub(r"[^\w.]", ".", name)
    return dotted if re.match(r"[^\W\d_]|\.(?!\d)", dotted) else "X" + dotted


def byte_sorted(values) -> list[str]:
    return sorted(set(values), key=lambda v: v.encode())


def treatment_levels(values: list[str], reference: str | None) -> list[str]:
    observed = byte_sorted(values)
    first = reference if reference is not None else observed[0]
    return [first] + [v for v in observed if v != first]


def build_model(
    samples: list[str],
    covariates: dict[str, list],
    types: dict[str, str],
    terms: list[str],
    references: dict[str, str],
    factor: str,
    numerator: str,
    denominator: str,
) -> Model:
    """Intercept, treatment-coded categories and numeric terms, with the contrast's denominator as reference."""
    columns, names = [np.ones(len(samples))], ["(Intercept)"]
    levels: dict[str, list[str]] = {}
    coefficient = -1
    for term in terms:
        values = covariates[term]
        if types[term] == "numeric":
            columns.append(np.array(values, dtype=float))
            names.append(term)
            continue
        reference = denominator if term == factor else references.get(term)
        levels[term] = treatment_levels(values, reference)
        if len(levels[term]) < 2:
            raise ContractError(f"design term {term} needs at least two levels")
        if len({syntactic(v) for v in levels[term]}) < len(levels[term]):
            raise ContractError(f"levels of {term} collide as coefficient names")
        for level in levels[term][1:]:
            if term == factor and level == numerator:
                coefficient = len(names)
            columns.append(np.array([1.0 if v == level else 0.0 for v in values]))
            names.append(f"{term}{level}")
    matrix = np.column_stack(columns)
    if not np.isfinite(matrix).all() or np.linalg.matrix_rank(matrix) < matrix.shape[1]:
        raise ContractError("model matrix is rank deficient")
    if matrix.shape[0] <= matrix.shape[1]:
        raise ContractError("model needs positive residual degrees of freedom")
    if len({syntactic(n) for n in names}) < len(names) or "sample_id" in names:
        raise ContractError("model column names are ambiguous or reserved")
    if coefficient < 0:
        raise ContractError("contrast has no coefficient in this design")
    return Model(
        samples=list(samples),
        matrix=matrix,
        names=names,
        coefficient=coefficient,
        coefficient_name=syntactic(f"{factor}_{numerator}_vs_{denominator}"),
        levels=levels,
        values={t: list(covariates[t]) for t in terms},
    )


def model_groups(models: list[Model]) -> list[int]:
    """Group number per contrast by first appearance; contrasts of one group share a fit."""
    firsts: list[Model] = []
    groups = []
    for model in models:
        hit = next((i for i, seen in enumerate(firsts) if model.same_fit(seen)), None)
        if hit is None:
            firsts.append(model)
            hit = len(firsts) - 1
        groups.append(hit)
    return groups
