"""One-against-rest support vectors with a Gaussian kernel, through random Fourier features
(Rahimi and Recht, "Random features for large-scale kernel machines", 2007).

Rows are projected once and stored. All margins are fitted together: a pass makes one matrix per task, the gradient of
every class's loss at once, and these are added up; the driver takes the steps by limited-memory BFGS. The hinge is
rounded off between its kink and the margin (Chapelle, "Training a support vector machine in the primal", 2007), so
that the steps have a gradient to follow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.operators.encode import code_of
from beatgrid.operators.passes import matrix, summed
from beatgrid.session import Scratch

#: Half of the stretch on which the hinge is rounded off.
ROUNDING = 0.5
#: Steps that shape the next direction.
MEMORY = 10


@dataclass(frozen=True)
class FourierFeatures:
    """cos(x W + b) columns whose inner products approximate the kernel exp(-gamma |x - y|^2)."""

    directions: np.ndarray
    phases: np.ndarray

    def waves(self, values: np.ndarray) -> np.ndarray:
        return np.cos(values @ self.directions + self.phases) * np.sqrt(2.0 / len(self.phases))


def fourier_features(inputs: int, outputs: int = 128, gamma: float | None = None, seed: int = 10) -> FourierFeatures:
    """Draw the directions; gamma defaults to one over the number of inputs."""
    gamma = 1.0 / inputs if gamma is None else gamma
    draw = np.random.default_rng(seed)
    return FourierFeatures(
        draw.normal(scale=np.sqrt(2.0 * gamma), size=(inputs, outputs)), draw.uniform(0.0, 2.0 * np.pi, outputs)
    )


@dataclass(frozen=True)
class KernelSVM:
    """One margin per class, ``waves @ weights + offsets``; probabilities are the softmax of the margins."""

    projection: FourierFeatures
    weights: np.ndarray
    offsets: np.ndarray
    features: tuple[str, ...]
    classes: tuple[str, ...]

    def predict_proba(self, df: DataFrame, *kept: str) -> DataFrame:
        """``kept`` columns with the arrays ``classes`` and ``p``."""

        @F.pandas_udf("array<double>")
        def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                margins = self.projection.waves(batch.to_numpy(dtype=float)) @ self.weights + self.offsets
                share = np.exp(margins - margins.max(axis=1, keepdims=True, initial=-np.inf))
                yield pd.Series(list(share / share.sum(axis=1, keepdims=True)), dtype=object)

        inputs: list[Column] = [F.col(f"`{name}`").cast("double").alias(f"x{i}") for i, name in enumerate(self.features)]
        names = F.array(*(F.lit(name) for name in self.classes))
        return df.select(*kept, names.alias("classes"), shares(F.struct(*inputs)).alias("p"))


def rounded_hinge(reached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """max(0, 1 - t) with a parabola around the kink, and its derivative."""
    short = 1.0 + ROUNDING - reached
    curve = np.clip(short, 0.0, 2 * ROUNDING)
    return curve**2 / (4 * ROUNDING) + np.maximum(short - 2 * ROUNDING, 0.0), -curve / (2 * ROUNDING)


def minimise(
    value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, iterations: int, tolerance: float
) -> np.ndarray:
    """Limited-memory BFGS with halved steps (Nocedal, 1980); a step's value and gradient come from one call."""
    at = start
    here, slope = value(at)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        direction, seen = slope.copy(), []
        for moved, bent in reversed(moves):
            share = moved.dot(direction) / moved.dot(bent)
            direction -= share * bent
            seen.append(share)
        if moves:
            direction *= moves[-1][0].dot(moves[-1][1]) / moves[-1][1].dot(moves[-1][1])
        else:
            direction /= max(1.0, float(np.sqrt(slope.dot(slope))))
        for (moved, bent), share in zip(moves, reversed(seen)):
            direction += (share - bent.dot(direction) / moved.dot(bent)) * moved
        step, fall = 1.0, slope.dot(direction)
        while True:
            there, next_slope = value(at - step * direction)
            if there <= here - 1e-4 * step * fall or step < 1e-6:
                break
            step /= 2
        moved, bent = -step * direction, next_slope - slope
        gained = here - there
        if gained <= 0:
            break
        at, here, slope = at + moved, there, next_slope
        if moved.dot(bent) > 1e-12 * bent.dot(bent):
            moves = [*moves[-MEMORY + 1 :], (moved, bent)]
        if gained <= tolerance * max(abs(here), 1.0):
            break
    return at


def _projected(train: DataFrame, projection: FourierFeatures, inputs: Sequence[Column], label: Column) -> DataFrame:
    @F.pandas_udf("array<double>")
    def waves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(projection.waves(batch.to_numpy(dtype=float))), dtype=object)

    return train.select(label.alias("label"), waves(F.struct(*inputs)).alias("waves"))


def _loss(rows: DataFrame, n_rows: int, classes: int, outputs: int, penalty: float):
    """The mean loss of all classes plus the penalty, and the gradient, of (outputs + 1) x classes parameters."""

    def value(parameters: np.ndarray) -> tuple[float, np.ndarray]:
        weights = parameters.reshape(outputs + 1, classes)

        def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros((outputs + 2, classes))
            for batch in batches:
                if batch.num_rows:
                    waves, label = matrix(batch.column("waves")), batch.column("label").to_numpy()
                    side = np.where(label[:, None] == np.arange(classes), 1.0, -1.0)
                    loss, bend = rounded_hinge(side * (waves @ weights[:-1] + weights[-1]))
                    bend *= side
                    out[:outputs] += waves.T @ bend
                    out[outputs] += bend.sum(axis=0)
                    out[outputs + 1] += loss.sum(axis=0)
            return out

        sums = summed(rows, work, (outputs + 2) * classes).reshape(outputs + 2, classes) / n_rows
        slope = sums[:-1].copy()
        slope[:-1] += penalty * weights[:-1]
        return float(sums[-1].sum() + penalty / 2 * (weights[:-1] ** 2).sum()), slope.ravel()

    return value


def fit_kernel_svm(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    classes: Sequence[str],
    n_rows: int,
    c: float = 1.0,
    iterations: int = 300,
    outputs: int = 128,
    seed: int = 10,
    tolerance: float = 1e-7,
) -> KernelSVM:
    """Fit on the features as given (scale them first); ``c`` weighs the summed loss.

    Ends after ``iterations`` steps, or when a step gains less than ``tolerance`` of the loss.
    """
    projection = fourier_features(len(features), outputs, seed=seed)
    inputs = [F.col(f"`{name}`").cast("double").alias(f"x{i}") for i, name in enumerate(features)]
    coded = code_of(F.col(label), classes).cast("int")
    with Scratch(train.sparkSession) as scratch:
        rows = scratch.keep(_projected(train, projection, inputs, coded), "svm-rows")
        loss = _loss(rows, n_rows, len(classes), outputs, 1.0 / (c * n_rows))
        found = minimise(loss, np.zeros((outputs + 1) * len(classes)), iterations, tolerance)
    weights = found.reshape(outputs + 1, len(classes))
    return KernelSVM(projection, weights[:-1], weights[-1], tuple(features), tuple(classes))
