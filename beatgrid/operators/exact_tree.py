"""A Gini decision tree with exact splits, grown level by level from counts.

Each level is one aggregation: (node, feature, value) with the number of rows of every class, combined before the
shuffle. These counts are range partitioned and sorted by (node, feature, value); running sums within a part, plus the
sums of the parts before it, give the classes left of every possible threshold, so no feature is ranked in one task.
The best split of each node comes to the driver, which holds the tree: a few nodes, as the depth is small.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatgrid.operators.encode import code_of
from beatgrid.session import Scratch


def drawn_features(features: Sequence[str], node: int, seed: int, how_many: int) -> list[int]:
    """The features a node may split on: those whose digest with the seed and the node comes first."""
    order = sorted(range(len(features)), key=lambda i: hashlib.md5(f"{seed}/{node}/{features[i]}".encode()).hexdigest())
    return sorted(order[:how_many])


@dataclass(frozen=True)
class Split:
    """Rows with a value up to the threshold go to node 2n, the others to 2n + 1."""

    feature: int
    threshold: float
    gain: float


@dataclass(frozen=True)
class ExactTree:
    """Splits and class counts by node; the root is node 1."""

    splits: dict[int, Split]
    counts: dict[int, list[int]]
    features: tuple[str, ...]
    classes: tuple[str, ...]

    def node_of(self, node: int = 1) -> Column:
        """The leaf that a row of the features' columns reaches."""
        if node not in self.splits:
            return F.lit(node)
        split = self.splits[node]
        value = F.col(f"`{self.features[split.feature]}`").cast("double")
        return F.when(value <= split.threshold, self.node_of(2 * node)).otherwise(self.node_of(2 * node + 1))

    def predict_proba(self, df: DataFrame, *kept: str) -> DataFrame:
        """``kept`` columns with the arrays ``classes`` and ``p``: the shares of the classes in a row's leaf."""
        shares = None
        for node, own in self.counts.items():
            if node not in self.splits:
                share = F.array(*(F.lit(n / sum(own)) for n in own))
                found = F.col("leaf") == node
                shares = F.when(found, share) if shares is None else shares.when(found, share)
        names = F.array(*(F.lit(name) for name in self.classes))
        return df.select(*kept, self.node_of().alias("leaf")).select(*kept, names.alias("classes"), shares.alias("p"))

    def importances(self, spark: SparkSession) -> DataFrame:
        """(rank, feature, importance), most important first: each feature's share of the impurity taken away."""
        gained = [0.0] * len(self.features)
        for node in sorted(self.splits):
            gained[self.splits[node].feature] += self.splits[node].gain
        total = sum(gained) or 1.0
        order = sorted(range(len(gained)), key=lambda i: (-gained[i], i))
        rows = [(rank, self.features[i], gained[i] / total) for rank, i in enumerate(order, start=1)]
        return spark.createDataFrame(rows, "rank int, feature string, importance double")


def _purity(squares: Column, size: Column) -> Column:
    return squares.cast("double") / size


def _level_counts(rows: DataFrame, allowed: dict[int, list[int]], n_features: int, classes: int) -> DataFrame:
    """(node, feature, value) with a count per class, of the features that the nodes may split on."""
    choices = None
    for node, own in allowed.items():
        mine = F.array(*(F.lit(i) for i in own))
        choices = F.when(F.col("node") == node, mine) if choices is None else choices.when(F.col("node") == node, mine)
    values = F.array(*(F.col(f"x{i}") for i in range(n_features)))
    pairs = F.transform(choices, lambda i: F.struct(i.alias("feature"), F.get(values, i).alias("value")))
    long = rows.where(F.col("node").isin(list(allowed))).select("node", "label", F.inline(pairs))
    return long.groupBy("node", "feature", "value").agg(
        *(F.count(F.when(F.col("label") == k, 1)).alias(f"c{k}") for k in range(classes))
    )


def _best_splits(counts: DataFrame, scratch: Scratch, classes: int, min_leaf: int) -> DataFrame:
    """The best valid split of each node: score, feature, threshold."""
    names = [f"c{k}" for k in range(classes)]
    key = ["node", "feature"]
    ranged = counts.repartitionByRange(*key, "value").sortWithinPartitions(*key, "value")
    ranged = scratch.keep(ranged.withColumn("part", F.spark_partition_id()), "value-counts")
    parts = ranged.groupBy("part", *key).agg(F.min("value").alias("first"), *(F.sum(c).alias(c) for c in names))
    by_part = Window.partitionBy(*key).orderBy("part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    parts = parts.select(
        "part",
        *key,
        F.lead("first").over(by_part).alias("next_part"),
        *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in names),
        *(F.sum(c).over(whole).alias(f"all_{c}") for c in names),
    )  # a row per part and per pair of a node and a feature at most
    in_part = Window.partitionBy("part", *key).orderBy("value")
    so_far = in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ranged.select(
        "part", *key, "value", F.lead("value").over(in_part).alias("next"), *(F.sum(c).over(so_far).alias(c) for c in names)
    ).join(F.broadcast(parts), ["part", *key])

    def added(columns: list[Column]) -> Column:
        total = columns[0]
        for column in columns[1:]:
            total = total + column
        return total

    left = [F.col(c) + F.col(f"before_{c}") for c in names]
    right = [F.col(f"all_{c}") - one for c, one in zip(names, left)]
    sized = running.select(
        *key,
        "value",
        F.coalesce("next", "next_part").alias("next"),
        added(left).alias("n_left"),
        added(right).alias("n_right"),
        added([c * c for c in left]).alias("left"),
        added([c * c for c in right]).alias("right"),
    )
    valid = F.col("next").isNotNull() & (F.col("n_left") >= min_leaf) & (F.col("n_right") >= min_leaf)
    score = _purity(F.col("left"), F.col("n_left")) + _purity(F.col("right"), F.col("n_right"))
    split = F.struct(
        score.alias("score"),
        (-F.col("feature")).alias("order"),
        (-F.col("value")).alias("lower"),
        ((F.col("value") + F.col("next")) / 2).alias("threshold"),
    )
    return sized.where(valid).groupBy("node").agg(F.max(split).alias("best"))


def fit_exact_tree(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    classes: Sequence[str],
    depth: int = 2,
    min_leaf: int = 20,
    min_split: int = 100,
    draw: str = "sqrt",
    seed: int = 100,
) -> ExactTree:
    """Grow a tree. A node is split if it has ``min_split`` rows of two classes and a split with ``min_leaf`` rows on
    both sides makes it purer; of equal splits the first feature's lowest is taken. ``draw`` is ``sqrt`` or ``all``."""
    n_features, n_classes = len(features), len(classes)
    how_many = n_features if draw == "all" else max(1, math.isqrt(n_features))
    coded = train.select(
        code_of(F.col(label), classes).cast("int").alias("label"),
        *(F.col(f"`{name}`").cast("double").alias(f"x{i}") for i, name in enumerate(features)),
    )
    splits: dict[int, Split] = {}
    counts: dict[int, list[int]] = {}
    inner = tuple(f"x{i}" for i in range(n_features))
    with Scratch(train.sparkSession) as scratch:
        rows = scratch.keep(coded, "tree-rows")
        for level in range(depth + 1):
            tree = ExactTree(splits, counts, inner, tuple(classes))
            placed = rows.withColumn("node", tree.node_of()).where(F.col("node") >= 2**level)
            sizes = placed.groupBy("node").agg(*(F.count(F.when(F.col("label") == k, 1)) for k in range(n_classes)))
            found = {row[0]: list(row)[1:] for row in sizes.collect()}
            counts.update(found)
            able = [node for node, own in found.items() if sum(own) >= min_split and sum(n > 0 for n in own) > 1]
            if level == depth or not able:
                break
            allowed = {node: drawn_features(features, node, seed, how_many) for node in able}
            best = _best_splits(_level_counts(placed, allowed, n_features, n_classes), scratch, n_classes, min_leaf)
            for node, split in best.collect():
                own = counts[node]
                gain = split["score"] - float(sum(n * n for n in own)) / sum(own)
                if gain > 1e-9:
                    splits[node] = Split(-split["order"], split["threshold"], gain)
    return ExactTree(splits, counts, tuple(features), tuple(classes))
