"""Multi-class boosting of small trees (Zhu, Zou, Rosset, Hastie, "Multi-class AdaBoost", 2009).

Features are binned once. Rows with equal bins and label share one weight for ever, so they become one row with a
count; these are stored in blocks, feature by feature. A round costs one pass per level of its tree: the pass sums weights by (node, feature, bin, class), and the
driver picks the splits from those sums. The error of the tree follows from the sums of its last level. Weights are
written back every ``ROUNDS_PER_TABLE`` rounds; in between a pass applies the trees since then.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.operators.encode import assemble
from beatgrid.operators.passes import blocks, matrix, summed, unpacked
from beatgrid.session import Scratch

ROUNDS_PER_TABLE = 25
#: Rows whose values set the thresholds: those with the smallest hashes.
THRESHOLD_ROWS = 10_000
#: Weights enter sums in whole units of this size, so that sums do not depend on the order of rows.
UNIT = 2.0**-24
#: Whole numbers up to here are exact as doubles.
WHOLE = 2.0**53
#: Levels of up to so many nodes are read node by node, which takes whole columns.
FEW_NODES = 4
#: What a block holds: labels, bins by feature, numbers of equal rows and weights.
BLOCK, KINDS = ("label", "bins", "n", "w"), (np.int32, np.uint8, np.int64, np.float64)


@dataclass(frozen=True)
class Bins:
    """Ascending thresholds of each feature; a value's bin is the number of thresholds below it."""

    thresholds: tuple[np.ndarray, ...]

    def __call__(self, values: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(edges, values[:, i], side="left") for i, edges in enumerate(self.thresholds)]
        return np.stack(found, axis=1).astype(np.uint8)

    @property
    def width(self) -> int:
        return 1 + max(map(len, self.thresholds))


def fit_bins(rows: DataFrame, most: int = 32) -> Bins:
    """At most ``most`` bins a feature: one per value where these suffice, else equally filled ones.

    Thresholds lie halfway between values of the ``THRESHOLD_ROWS`` rows with the smallest hashes.
    """
    values = vector_to_array("features").alias("values")
    sample = rows.select(values).orderBy(F.xxhash64("values"), "values").limit(THRESHOLD_ROWS).toArrow()
    table = matrix(sample.column("values").combine_chunks())
    thresholds = []
    for column in table.T:
        distinct, counts = np.unique(column, return_counts=True)
        between = (distinct[:-1] + distinct[1:]) / 2
        if len(distinct) > most:
            wanted = np.arange(1, most) * (counts.sum() / most)
            between = between[np.unique(np.searchsorted(np.cumsum(counts[:-1]), wanted).clip(0, len(between) - 1))]
        thresholds.append(between)
    return Bins(tuple(thresholds))


@dataclass(frozen=True)
class Tree:
    """A complete binary tree: the feature and the last left bin of each inner node by level, a class per leaf."""

    depth: int
    feature: np.ndarray
    last_left: np.ndarray
    leaf: np.ndarray

    def place(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after some levels, counted from 0 in its level."""
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for level in range(levels):
            first = 2**level - 1
            if 2**level > FEW_NODES:
                inner = node + first
                node = 2 * node + (bins[rows, self.feature[inner]] > self.last_left[inner])
                continue
            right = np.zeros(len(bins), bool)
            for own in range(2**level):
                beyond = bins[:, self.feature[first + own]] > int(self.last_left[first + own])
                right |= beyond & (node == own)
            node = 2 * node + right
        return node

    def classes(self, bins: np.ndarray) -> np.ndarray:
        return self.leaf[self.place(bins, self.depth)]


def best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sums by (node, feature, bin, class): the feature and the last left bin of the split with the least Gini
    impurity, the first of equal ones; a node that no split improves sends every row to the left."""
    left = np.cumsum(sums, axis=2, dtype=np.float64)
    whole = left[:, :, -1:, :]
    right = whole - left

    def purity(part: np.ndarray) -> np.ndarray:
        size = part.sum(axis=-1)
        return np.divide((part**2).sum(axis=-1), size, out=np.zeros_like(size), where=size > 0)

    score = purity(left) + purity(right)
    valid = (left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0)
    score = np.where(valid, score, -1.0).reshape(len(sums), -1)
    best = score.argmax(axis=1)
    enough = score[np.arange(len(sums)), best] > purity(whole)[:, 0, 0] * (1 + 1e-12)
    feature, last_left = np.divmod(best, sums.shape[2])
    return np.where(enough, feature, 0), np.where(enough, last_left, 255)


def grow(depth: int, sums_of: Callable[[Tree, int], np.ndarray]) -> tuple[Tree, float]:
    """A tree from ``sums_of(tree so far, level)``, and the share of the weight that it misses."""
    inner = 2**depth - 1
    tree = Tree(depth, np.zeros(inner, np.int64), np.full(inner, 255), np.zeros(2**depth, np.int64))
    for level in range(depth):
        sums = sums_of(tree, level)
        at = slice(2**level - 1, 2 ** (level + 1) - 1)
        tree.feature[at], tree.last_left[at] = best_splits(sums)
    leaves = np.zeros((2**depth, sums.shape[-1]))
    for node, (feature, last_left) in enumerate(zip(tree.feature[at], tree.last_left[at])):
        own = sums[node, feature]
        leaves[2 * node] = own[: last_left + 1].sum(axis=0)
        leaves[2 * node + 1] = own[last_left + 1 :].sum(axis=0)
    tree.leaf[:] = leaves.argmax(axis=1)
    return tree, 1.0 - leaves.max(axis=1).sum() / leaves.sum()


@dataclass(frozen=True)
class Round:
    """A tree, the weight of its vote, and by what the weights of rows it gets wrong and right change."""

    tree: Tree
    vote: float
    wrong: float = 1.0
    right: float = 1.0


@dataclass(frozen=True)
class BoostedTrees:
    """Trees with the weight of their votes."""

    bins: Bins
    rounds: tuple[Round, ...]
    classes: tuple[str, ...]

    def votes(self, values: np.ndarray) -> np.ndarray:
        """Votes by (row, class)."""
        bins, rows = self.bins(values), np.arange(len(values))
        votes = np.zeros((len(values), len(self.classes)))
        for one in self.rounds:
            votes[rows, one.tree.classes(bins)] += one.vote
        return votes

    def predict_proba(self, df: DataFrame, features: Sequence[str], *kept: str) -> DataFrame:
        """``kept`` columns with the arrays ``classes`` and ``p``."""
        sharpness = 1.0 / (sum(one.vote for one in self.rounds) * max(1, len(self.classes) - 1))

        @F.pandas_udf("array<double>")
        def shares(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                share = np.exp(self.votes(np.stack(batch.to_list())) * sharpness) if len(batch) else []
                yield pd.Series([row / row.sum() for row in share], dtype=object)

        names = F.array(*(F.lit(name) for name in self.classes))
        scored = assemble(df, features, *kept)
        return scored.select(*kept, names.alias("classes"), shares(vector_to_array("features")).alias("p"))


def _binned(train: DataFrame, bins: Bins) -> DataFrame:
    """Blocks of (label, bins, n) of equal rows, with weight 1."""

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [row.tobytes() for row in bins(matrix(batch.column("values")))]
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found)], names=["label", "bins"])

    def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
        own = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        return [batch.column("label").to_numpy(), own.T, batch.column("n").to_numpy(), np.ones(batch.num_rows)]

    rows = train.select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("values"))
    equal = rows.mapInArrow(binned, "label int, bins binary").groupBy("label", "bins").agg(F.count("*").alias("n"))
    return blocks(equal, BLOCK, arrays)


def _weighted(
    batches: Iterator[pa.RecordBatch], since: Sequence[Round]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Labels, bins by row, counts and weights of each block after the rounds since the table was written."""
    for label, flat, n, w in unpacked(batches, *KINDS):
        bins = flat.reshape(-1, len(label)).T  # a feature's bins lie side by side
        for one in since:
            w = w * np.where(one.tree.classes(bins) == label, one.right, one.wrong)
        yield label, bins, n, w


def _added(place: np.ndarray, units: np.ndarray, size: int) -> np.ndarray:
    """Sums by place, as whole numbers; ``units`` are doubles where their sums are exact as such, which is faster."""
    if units.dtype == np.float64:
        return np.bincount(place, weights=units, minlength=size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, place, units)
    return out


def _sums(
    table: DataFrame, tasks: int, since: Sequence[Round], tree: Tree, level: int, features: int, width: int, classes: int
) -> np.ndarray:
    """Units of weight by (node of a level, feature, bin, class)."""
    shape = (2**level, features, width, classes)

    def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(shape, np.int64)
        for label, bins, n, w in _weighted(batches, since):
            units = np.rint(w / UNIT).astype(np.int64) * n
            if units.sum(dtype=np.float64) < WHOLE / 2:
                units = units.astype(np.float64)
            node = tree.place(bins, level) * (width * classes) + label
            for feature in range(features):
                place = np.multiply(bins[:, feature], classes, dtype=np.int64)
                place += node
                out[:, feature] += _added(place, units, 2**level * width * classes).reshape(-1, width, classes)
        return out

    return summed(table, work, int(np.prod(shape)), whole=True, tasks=tasks).reshape(shape)


def _reweighted(table: DataFrame, since: Sequence[Round]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, bins, n, w in _weighted(batches, since):
            found = [pa.array([part.tobytes()]) for part in (label, bins.T, n, w)]
            yield pa.RecordBatch.from_arrays(found, names=list(BLOCK))

    return table.mapInArrow(work, table.schema)


def fit_boosted_trees(
    train: DataFrame,
    classes: Sequence[str],
    rounds: int = 600,
    depth: int = 2,
    rate: float = 1.5,
    bins: int = 32,
) -> BoostedTrees:
    """Boost Gini trees on (label, features) rows, raising the weight of rows a round gets wrong.

    Ends early when a tree makes no mistake, or is no better than guessing.
    """
    with Scratch(train.sparkSession) as scratch:
        edges = fit_bins(train, bins)
        table = scratch.keep(_binned(train, edges), "boosting-rows")
        tasks = table.rdd.getNumPartitions()
        found: list[Round] = []
        since: list[Round] = []
        for _ in range(rounds):
            shape = len(edges.thresholds), edges.width, len(classes)
            tree, error = grow(depth, lambda t, level: _sums(table, tasks, since, t, level, *shape))
            if error >= 1.0 - 1.0 / len(classes):
                if not found:
                    raise ValueError("the first tree is no better than guessing")
                break
            if error <= 0.0:
                found.append(Round(tree, 1.0))
                break
            vote = rate * (math.log((1.0 - error) / error) + math.log(len(classes) - 1))
            raised = math.exp(vote)
            scale = 1.0 / ((1.0 - error) + error * raised)
            found.append(Round(tree, vote, raised * scale, scale))
            since.append(found[-1])
            if len(since) == ROUNDS_PER_TABLE:
                table = scratch.keep(_reweighted(table, since), "boosting-rows")
                since = []
        return BoostedTrees(edges, tuple(found), tuple(classes))
