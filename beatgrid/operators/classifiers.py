"""Multi-class models: Spark ML estimators with the established parameters as defaults.

``fit`` functions take training rows with a vector ``features`` and a numeric ``label`` that counts
the classes from 0 in ascending order of their names. ``predict_proba`` returns the arrays
``classes`` and ``p`` for any model.
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.operators.encode import assemble, code_of

# Settings of the grid search.
SEARCH_DEPTHS = (2, 4, 6)
SEARCH_TREES = (10, 20, 30)
SEARCH_LEAVES = (40, 60, 100)


def training_rows(df: DataFrame, features: Sequence[str], label: str, classes: Sequence[str]) -> DataFrame:
    """(label, features) for ``fit``."""
    coded = df.withColumn("label", code_of(F.col(label), classes).cast("double"))
    return assemble(coded, features, "label")


def random_forest(
    trees: int = 700, depth: int = 13, features: str = "sqrt", min_leaf: int = 1, seed: int = 10
) -> RandomForestClassifier:
    """Random forest.

    Row-to-node ids are kept with the rows, so deep forests are not sent around, and the memory for
    node statistics is raised, so that more nodes are split in one pass over the rows.
    """
    return RandomForestClassifier(
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy=features,
        minInstancesPerNode=min_leaf,
        seed=seed,
        cacheNodeIds=True,
        maxMemoryInMB=1024,
        checkpointInterval=10,
    )


def decision_tree(
    depth: int = 2, min_leaf: int = 20, features: str = "sqrt", seed: int = 100
) -> RandomForestClassifier | DecisionTreeClassifier:
    """Gini tree; drawing features at each split takes a forest of one tree over all rows."""
    if features == "all":
        return DecisionTreeClassifier(impurity="gini", maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed)
    return RandomForestClassifier(
        impurity="gini",
        numTrees=1,
        bootstrap=False,
        subsamplingRate=1.0,
        featureSubsetStrategy=features,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        seed=seed,
    )


def logistic_regression(
    n_rows: int, penalty: str = "l1", inverse_strength: float = 1.0, iterations: int = 400, tolerance: float = 1e-4
) -> LogisticRegression:
    """Multinomial regression; ``inverse_strength`` weighs the summed loss, Spark averages it."""
    return LogisticRegression(
        family="multinomial",
        elasticNetParam={"l1": 1.0, "l2": 0.0}[penalty],
        regParam=1.0 / (inverse_strength * n_rows),
        standardization=False,
        maxIter=iterations,
        tol=tolerance,
    )


def naive_bayes(smoothing: float = 0.01) -> NaiveBayes:
    """Multinomial naive Bayes on non-negative features; here the class shares are smoothed too."""
    return NaiveBayes(modelType="multinomial", smoothing=smoothing)


def perceptron(inputs: int, classes: int, hidden: int = 8, iterations: int = 200, seed: int = 10) -> MultilayerPerceptronClassifier:
    """One hidden layer and a softmax output."""
    return MultilayerPerceptronClassifier(layers=[inputs, hidden, classes], maxIter=iterations, seed=seed)


def predict_proba(model: Model, df: DataFrame, features: Sequence[str], classes: Sequence[str], *kept: str) -> DataFrame:
    """``kept`` columns with the arrays ``classes`` and ``p``."""
    scored = model.transform(assemble(df, features, *kept))
    names = F.array(*(F.lit(name) for name in classes))
    return scored.select(*kept, names.alias("classes"), vector_to_array("probability").alias("p"))


def feature_importance(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    """(rank, feature, importance), most important first; as many rows as features."""
    importance = model.featureImportances.toArray()
    order = sorted(range(len(features)), key=lambda i: (-importance[i], i))
    rows = [(rank, features[i], float(importance[i])) for rank, i in enumerate(order, start=1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def _folds(train: DataFrame, folds: int, seed: int) -> list[tuple[DataFrame, DataFrame]]:
    """Rows to fit on and rows to score for each fold of a column ``fold``, or of random ones without it."""
    if "fold" in train.columns:
        named = F.col("fold")
        known = F.when(named.between(0, folds - 1), named).otherwise(F.raise_error(F.lit(f"a row is in none of {folds} folds")))
        parts = [known == fold for fold in range(folds)]
        return [(train.where(~part), train.where(part)) for part in parts]
    drawn = train.select("*", F.rand(seed).alias("drawn"))
    parts = [(F.col("drawn") >= fold / folds) & (F.col("drawn") < (fold + 1) / folds) for fold in range(folds)]
    return [(drawn.where(~part), drawn.where(part)) for part in parts]


def _refuse_empty(train: DataFrame, fit_on: DataFrame, rest: DataFrame) -> None:
    if "fold" in train.columns and (fit_on.isEmpty() or rest.isEmpty()):
        raise ValueError("a fold, or what is left without it, is empty")


def cross_validate(
    train: DataFrame, estimator, folds: int = 4, seed: int = 10, metric: str = "accuracy", parallelism: int = 2
) -> DataFrame:
    """(folds, metric, mean_score, std_score) over the folds of a column ``fold``, or random ones without it.

    Each fold's model is fitted once, ``parallelism`` of them at a time; none is fitted to all rows, as only the scores
    are asked for. Rows are left to the estimator to keep, which holds them in its own form.
    """
    evaluator = MulticlassClassificationEvaluator(metricName=metric)

    def score(part: tuple[DataFrame, DataFrame]) -> float:
        fit_on, rest = part
        _refuse_empty(train, fit_on, rest)
        return evaluator.evaluate(estimator.fit(fit_on).transform(rest))

    with ThreadPool(max(1, min(parallelism, folds))) as pool:
        scores = pool.map(inheritable_thread_target(train.sparkSession)(score), _folds(train, folds, seed), chunksize=1)
    row = (folds, metric, float(np.mean(scores)), float(np.std(scores)))
    return train.sparkSession.createDataFrame([row], "folds int, metric string, mean_score double, std_score double")


def grid_search(
    train: DataFrame,
    depths: Sequence[int] = SEARCH_DEPTHS,
    trees: Sequence[int] = SEARCH_TREES,
    leaves: Sequence[int] = SEARCH_LEAVES,
    folds: int = 3,
    seed: int = 10,
    parallelism: int = 4,
) -> DataFrame:
    """(depth, trees, min_leaf, accuracy, is_best) for every setting of a random forest, over the folds of a column
    ``fold``, or random ones without it.

    Each setting is fitted once to each fold, ``parallelism`` of them at a time; none is fitted to all rows, as only the
    scores are asked for. The trees are small, so a row's nodes are found anew in each pass and not kept with the rows.
    """
    forest = random_forest(features="log2", seed=seed).setCacheNodeIds(False)
    settings = (
        ParamGridBuilder()
        .addGrid(forest.maxDepth, list(depths))
        .addGrid(forest.numTrees, list(trees))
        .addGrid(forest.minInstancesPerNode, list(leaves))
        .build()
    )
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    scores = []
    for fit_on, rest in _folds(train, folds, seed):
        _refuse_empty(train, fit_on, rest)
        fit_on, rest = fit_on.cache(), rest.cache()

        def score(setting: dict) -> float:
            return evaluator.evaluate(forest.fit(fit_on, setting).transform(rest))

        with ThreadPool(max(1, min(parallelism, len(settings)))) as pool:
            scores.append(pool.map(inheritable_thread_target(train.sparkSession)(score), settings, chunksize=1))
        fit_on.unpersist()
        rest.unpersist()
    accuracies = np.mean(scores, axis=0)
    best = max(range(len(settings)), key=lambda i: accuracies[i])
    rows = [
        (s[forest.maxDepth], s[forest.numTrees], s[forest.minInstancesPerNode], float(score), i == best)
        for i, (s, score) in enumerate(zip(settings, accuracies))
    ]
    return train.sparkSession.createDataFrame(
        rows, "depth int, trees int, min_leaf int, accuracy double, is_best boolean"
    )
