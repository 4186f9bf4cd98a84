"""A network with one rectified hidden layer and a softmax output, fitted by Adam (Kingma and Ba, 2015).

A step takes the rows that a hash of their key and the epoch deals to it; its gradient is added up over tasks. With
one step an epoch that is a full batch, and the rows are stored in blocks. The parameters are a few numbers, which go along with each pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.operators.encode import code_of
from beatgrid.operators.passes import blocks, matrix, summed, unpacked
from beatgrid.session import Scratch

# The decay of both moments, and what keeps a step finite.
FIRST, SECOND, FINITE = 0.9, 0.999, 1e-7
#: Rows whose gradient is worked out at a time.
TILE = 1_024


@dataclass(frozen=True)
class Layers:
    """Weights and offsets of both layers."""

    parts: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]

    @staticmethod
    def drawn(inputs: int, hidden: int, outputs: int, seed: int) -> Layers:
        """Uniform weights whose range follows from a layer's sides (Glorot and Bengio, 2010), offsets of zero."""
        draw = np.random.default_rng(seed)

        def layer(a: int, b: int) -> np.ndarray:
            return draw.uniform(-1, 1, (a, b)) * np.sqrt(6 / (a + b))

        return Layers((layer(inputs, hidden), np.zeros(hidden), layer(hidden, outputs), np.zeros(outputs)))

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self.parts])

    def like(self, flat: np.ndarray) -> Layers:
        cuts = np.cumsum([part.size for part in self.parts])[:-1]
        return Layers(tuple(new.reshape(old.shape) for new, old in zip(np.split(flat, cuts), self.parts)))

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hidden layer, and the probabilities."""
        w1, b1, w2, b2 = self.parts
        hidden = np.maximum(x @ w1 + b1, 0)
        out = hidden @ w2 + b2
        share = np.exp(out - out.max(axis=1, keepdims=True))
        return hidden, share / share.sum(axis=1, keepdims=True)

    def slope(self, x: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The gradient of the summed cross-entropy, by tiles of rows that stay near the processor; rows lie side by side."""
        w1, b1, w2, b2 = self.parts
        total = np.zeros(sum(part.size for part in self.parts))
        for start in range(0, len(label), TILE):
            own, of = x[start : start + TILE], label[start : start + TILE]
            hidden = np.maximum(w1.T @ own.T + b1[:, None], 0)
            p = w2.T @ hidden + b2[:, None]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            p[of, np.arange(len(of))] -= 1
            back = (w2 @ p) * (hidden > 0)
            total += np.concatenate([(own.T @ back.T).ravel(), back.sum(axis=1), (hidden @ p.T).ravel(), p.sum(axis=1)])
        return total


class Adam:
    """Steps from gradients, with decaying means of them and of their squares."""

    def __init__(self, size: int, rate: float) -> None:
        self.mean, self.square, self.steps, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, at: np.ndarray, slope: np.ndarray) -> np.ndarray:
        self.steps += 1
        self.mean = FIRST * self.mean + (1 - FIRST) * slope
        self.square = SECOND * self.square + (1 - SECOND) * slope**2
        pace = self.rate * np.sqrt(1 - SECOND**self.steps) / (1 - FIRST**self.steps)
        return at - pace * self.mean / (np.sqrt(self.square) + FINITE)


def _from_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labels and features of the rows of each batch."""
    for batch in batches:
        if batch.num_rows:
            yield batch.column("label").to_numpy(), matrix(batch.column("values"))


def _from_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same of rows stored in blocks."""
    for label, flat in unpacked(batches, np.int32, np.float64):
        yield label, flat.reshape(len(label), -1)


@dataclass(frozen=True)
class Network:
    layers: Layers
    features: tuple[str, ...]
    classes: tuple[str, ...]

    def predict_proba(self, df: DataFrame, *kept: str) -> DataFrame:
        """``kept`` columns with the arrays ``classes`` and ``p``."""

        @F.pandas_udf("array<double>")
        def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                found = self.layers.forward(batch.to_numpy(dtype=float))[1] if len(batch) else []
                yield pd.Series(list(found), dtype=object)

        inputs = [F.col(f"`{name}`").cast("double").alias(f"x{i}") for i, name in enumerate(self.features)]
        names = F.array(*(F.lit(name) for name in self.classes))
        return df.select(*kept, names.alias("classes"), shares(F.struct(*inputs)).alias("p"))


def fit_network(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    classes: Sequence[str],
    hidden: int = 8,
    epochs: int = 200,
    steps: int = 1,
    rate: float = 0.001,
    seed: int = 10,
) -> Network:
    """Fit on the features as given (scale them first); ``steps`` passes an epoch, each over its share of the rows."""
    layers = Layers.drawn(len(features), hidden, len(classes), seed)
    at = layers.flat()
    adam = Adam(len(at), rate)
    values = F.array(*(F.col(f"`{name}`").cast("double") for name in features)).alias("values")
    coded = train.select(F.col(f"`{key}`").alias("key"), code_of(F.col(label), classes).cast("int").alias("label"), values)
    with Scratch(train.sparkSession) as scratch:
        stored, parts = coded, _from_rows
        if steps == 1:  # every pass takes all rows, as they are stored
            stored = blocks(coded, ("label", "x"), lambda batch: next(iter(_from_rows([batch]))))
            parts = _from_blocks
        rows = scratch.keep(stored, "network-rows")
        for epoch in range(epochs):
            for step in range(steps):
                now = layers.like(at)

                def work(batches: Iterator[pa.RecordBatch], now: Layers = now) -> np.ndarray:
                    out = np.zeros(len(at) + 1)
                    for label_codes, x in parts(batches):
                        out[:-1] += now.slope(x, label_codes)
                        out[-1] += len(label_codes)
                    return out

                dealt = F.pmod(F.xxhash64("key", F.lit(epoch)), F.lit(steps)) == step
                sums = summed(rows.where(dealt) if steps > 1 else rows, work, len(at) + 1)
                if sums[-1]:
                    at = adam.step(at, sums[:-1] / sums[-1])
    return Network(layers.like(at), tuple(features), tuple(classes))
