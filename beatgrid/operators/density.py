"""Gaussian kernel density of columns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Grid points per curve, and how many bandwidths a curve reaches past the data.
GRID_POINTS = 100
CUT = 3.0


def kernel_density(df: DataFrame, *columns: str, points: int = GRID_POINTS, cut: float = CUT) -> DataFrame:
    """(feature, point, x, density) of each column on an even grid, bandwidth s * n ** (-1/5).

    A constant column has no bandwidth and so a null density.
    Equal values are counted first, so the sum runs over distinct values; each of them contributes to
    a fixed number of grid points, and the contributions are added up before they are shuffled.
    """
    pairs = [F.struct(F.lit(name).alias("feature"), F.col(name).cast("double").alias("value")) for name in columns]
    counts = (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranges = df.agg(
        *(
            F.struct(
                F.count(name).alias("n"),
                F.stddev_samp(name).alias("s"),
                F.min(name).cast("double").alias("low"),
                F.max(name).cast("double").alias("high"),
            ).alias(name)
            for name in columns
        )
    )
    stats = F.create_map(*(part for name in columns for part in (F.lit(name), F.col(name))))
    width = F.col("stat.s") * F.pow(F.col("stat.n").cast("double"), F.lit(-0.2))
    start = F.col("stat.low") - F.lit(cut) * F.col("h")
    step = (F.col("stat.high") - F.col("stat.low") + F.lit(2.0 * cut) * F.col("h")) / F.lit(float(points - 1))
    placed = (
        counts.withColumn("stats", ranges.select(stats).scalar())
        .withColumn("stat", F.col("stats")[F.col("feature")])
        .withColumn("h", width)
        .select("feature", "value", "n", "h", "stat.n", start.alias("start"), step.alias("step"))
        .toDF("feature", "value", "weight", "h", "n", "start", "step")
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    )
    x = F.col("start") + F.col("point") * F.col("step")
    kernel = F.exp(F.pow(F.try_divide(x - F.col("value"), F.col("h")), F.lit(2.0)) * F.lit(-0.5))
    scale = F.col("n") * F.col("h") * F.lit(math.sqrt(2.0 * math.pi))
    return placed.groupBy("feature", "point").agg(
        F.first(x).alias("x"), F.sum(F.try_divide(F.col("weight") * kernel, scale)).alias("density")
    )
