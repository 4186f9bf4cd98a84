"""Naive Bayes from sums, multinomial and Gaussian: aggregations to fit, one projection to predict."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.sums import exact_mean, exact_sum
from beatgrid.session import materialize


@dataclass(frozen=True)
class NaiveBayes:
    """Per class: log share of training rows, and smoothed log share of each feature."""

    table: DataFrame
    features: tuple[str, ...]

    def predict_proba(self, df: DataFrame, *kept: str) -> DataFrame:
        """``kept`` columns with the arrays ``classes`` and ``p``."""
        model = self.table.agg(
            F.array_sort(F.collect_list(F.struct("class", "log_prior", "log_shares")))
        ).scalar()
        inputs = [F.col(name).cast("double") for name in self.features]
        names = [f"x{j}" for j in range(len(inputs))]

        def class_score(c: Column) -> Column:
            terms = [F.col(name) * c["log_shares"][j] for j, name in enumerate(names)]
            return reduce(add, terms, c["log_prior"])

        scored = (
            df.select(*kept, *(x.alias(name) for x, name in zip(inputs, names)))
            .withColumn("model", model)
            .withColumn("scores", F.transform("model", class_score))
            .withColumn("top", F.array_max("scores"))
            .withColumn("shares", F.transform("scores", lambda s: F.exp(s - F.col("top"))))
            .withColumn("total", F.aggregate("shares", F.lit(0.0), lambda total, s: total + s))
        )
        return scored.select(
            *kept,
            F.transform("model", lambda c: c["class"]).alias("classes"),
            F.transform("shares", lambda s: s / F.col("total")).alias("p"),
        )


def fit_naive_bayes(
    train: DataFrame, features: Sequence[str], label: str, smoothing: float = 0.01
) -> NaiveBayes:
    """Fit on non-negative features in one pass; the class shares themselves are not smoothed."""
    sums = train.groupBy(F.col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("rows"), F.array(*(exact_sum(F.col(name)).cast("double") for name in features)).alias("sums")
    )
    sums = materialize(sums, "bayes-sums")
    all_rows = sums.agg(F.sum("rows")).scalar()
    total = F.aggregate("sums", F.lit(0.0), lambda t, s: t + s) + F.lit(smoothing * len(features))
    table = (
        sums.withColumn("total", total)
        .withColumn("all_rows", all_rows)
        .select(
            "class",
            F.log(F.col("rows") / F.col("all_rows")).alias("log_prior"),
            F.transform("sums", lambda s: F.log((s + F.lit(smoothing)) / F.col("total"))).alias("log_shares"),
        )
    )
    return NaiveBayes(table, tuple(features))


@dataclass(frozen=True)
class GaussianBayes:
    """Per class: log share of training rows, and mean and variance of each feature."""

    table: DataFrame
    features: tuple[str, ...]

    def predict_proba(self, df: DataFrame, *kept: str) -> DataFrame:
        """``kept`` columns with the arrays ``classes`` and ``p``."""
        fields = F.struct("class", "log_prior", "means", "variances")
        model = self.table.agg(F.array_sort(F.collect_list(fields))).scalar()
        names = [f"x{j}" for j in range(len(self.features))]
        inputs = [F.col(f"`{name}`").cast("double").alias(own) for name, own in zip(self.features, names)]

        def class_score(c: Column) -> Column:
            terms = []
            for j, name in enumerate(names):
                away, spread = F.col(name) - c["means"][j], c["variances"][j]
                terms.append(F.lit(-0.5) * (F.log(spread * F.lit(2 * math.pi)) + away * away / spread))
            return reduce(add, terms, c["log_prior"])

        scored = (
            df.select(*kept, *inputs)
            .withColumn("model", model)
            .withColumn("scores", F.transform("model", class_score))
            .withColumn("top", F.array_max("scores"))
            .withColumn("shares", F.transform("scores", lambda s: F.exp(s - F.col("top"))))
            .withColumn("total", F.aggregate("shares", F.lit(0.0), lambda total, s: total + s))
        )
        return scored.select(
            *kept,
            F.transform("model", lambda c: c["class"]).alias("classes"),
            F.transform("shares", lambda s: s / F.col("total")).alias("p"),
        )


def fit_gaussian_bayes(
    train: DataFrame, features: Sequence[str], label: str, smoothing: float = 1e-9
) -> GaussianBayes:
    """Normal densities by class from exact sums, in two passes: means, then squared distances from them.

    Every variance is raised by ``smoothing`` times the largest variance of a feature over all rows, so a feature that
    is constant in a class has a density.
    """
    values = [F.col(f"`{name}`").cast("double") for name in features]
    means = materialize(
        train.groupBy(F.col(label).alias("class")).agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*(exact_mean(value) for value in values)).alias("means"),
        ),
        "gaussian-means",
    )
    everywhere = train.agg(*(exact_mean(value).alias(f"m{j}") for j, value in enumerate(values))).first()
    n_rows = means.agg(F.sum("n")).first()[0] or 1
    widest = train.agg(
        *(exact_sum((value - F.lit(mean)) * (value - F.lit(mean))) for value, mean in zip(values, everywhere))
    ).first()
    raised = smoothing * max([float(total or 0) / n_rows for total in widest], default=0.0)
    known = train.join(F.broadcast(means), F.col(label).eqNullSafe(F.col("class")))  # a row per class
    away = [value - F.col("means")[j] for j, value in enumerate(values)]
    spreads = known.groupBy("class").agg(
        F.first("n").alias("n"),
        F.first("means").alias("means"),
        F.array(*(exact_sum(one * one).cast("double") for one in away)).alias("squares"),
    )
    table = spreads.select(
        "class",
        F.log(F.col("n") / F.lit(n_rows)).alias("log_prior"),
        "means",
        F.transform("squares", lambda s: s / F.col("n") + F.lit(raised)).alias("variances"),
    )
    return GaussianBayes(materialize(table, "gaussian-model"), tuple(features))
