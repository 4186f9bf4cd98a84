"""Truncated singular vectors without centring, by a randomised range finder (Halko, Martinsson, Tropp, 2011).

Each pass adds up, over tasks, the feature side of the rows' products with a few directions: a matrix of one row per
feature. The driver only makes such matrices orthogonal; rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.operators.passes import matrix, summed

EXTRA = 5


@dataclass(frozen=True)
class SingularVectors:
    """Right singular vectors by (feature, component) and singular values, largest first."""

    vectors: np.ndarray
    values: np.ndarray
    features: tuple[str, ...]

    def projections(self) -> list[Column]:
        out = []
        for vector in self.vectors.T:
            total = F.lit(0.0)
            for name, weight in zip(self.features, vector):
                total = total + F.col(f"`{name}`").cast("double") * F.lit(float(weight))
            out.append(total)
        return out


def fit_singular(df: DataFrame, features: Sequence[str], k: int, passes: int = 5, seed: int = 10) -> SingularVectors:
    """The first ``k`` right singular vectors; signs are settled, the largest weight of each is positive."""
    rows = df.select(F.array(*(F.col(f"`{name}`").cast("double") for name in features)).alias("values"))
    n, width = len(features), min(len(features), k + EXTRA)

    def spread(directions: np.ndarray) -> np.ndarray:
        """A^T A times some directions."""

        def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros((n, directions.shape[1]))
            for batch in batches:
                if batch.num_rows:
                    values = matrix(batch.column("values"))
                    out += values.T @ (values @ directions)
            return out

        return summed(rows, work, n * directions.shape[1]).reshape(n, -1)

    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, width)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(spread(basis))[0]
    squares, turned = np.linalg.eigh(basis.T @ spread(basis))
    order = np.argsort(-squares, kind="stable")[:k]
    vectors = basis @ turned[:, order]
    largest = vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])]
    return SingularVectors(
        vectors * np.where(largest < 0, -1.0, 1.0), np.sqrt(np.maximum(squares[order], 0.0)), tuple(features)
    )
