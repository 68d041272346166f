"""Means, variances and covariances of many columns from one aggregate, and principal axes from those."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usertide.schema import quoted


@dataclass(frozen=True)
class Moments:
    """First and second moments of ``columns`` over ``n`` rows; as large as the number of columns squared."""

    columns: list[str]
    n: int
    means: np.ndarray
    covariance: np.ndarray

    @property
    def scales(self) -> np.ndarray:
        """Standard deviations, 1 for a constant column."""
        deviations = np.sqrt(np.diag(self.covariance))
        return np.where(deviations > 0, deviations, 1.0)

    @property
    def correlation(self) -> np.ndarray:
        """Covariances of the standardised columns; a constant column has none."""
        return self.covariance / np.outer(self.scales, self.scales)

    def scaled(self) -> list[Column]:
        """The standardised columns."""
        return [
            (F.col(quoted(c)).cast("double") - F.lit(float(m))) / F.lit(float(s))
            for c, m, s in zip(self.columns, self.means, self.scales)
        ]


def second_moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Population moments of the columns in one pass, combined per task before the shuffle.

    Nulls count as 0 throughout, so that all pairs are taken over the same rows.  No rows give zeros.
    """
    columns = list(columns)
    values = [F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) for c in columns]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
        *[F.covar_pop(values[i], values[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    covariance = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        covariance[i, j] = covariance[j, i] = row[f"c{i}_{j}"] or 0.0
    means = np.array([row[f"m{i}"] or 0.0 for i in range(len(columns))])
    return Moments(columns, row["n"], means, covariance)


def principal_axes(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix and their unit vectors, as rows.

    Each vector points so that its largest entry by size is positive (the positive one on a tie).
    """
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:k]
    axes = vectors.T[order]
    return values[order], np.array([a if a.max() >= -a.min() else -a for a in axes])
