"""Class probabilities, held as the arrays ``classes`` and ``p``, and their scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.sums import exact_mean

# Fixed value: probabilities are kept this far away from 0 and 1.
EPSILON = 1e-15


def long_form(probabilities: DataFrame, *kept: str) -> DataFrame:
    """One row (``kept`` columns, class, p) per class."""
    pairs = F.arrays_zip("classes", "p")
    return probabilities.select(*kept, F.explode(pairs).alias("pair")).select(
        *kept, F.col("pair.classes").alias("class"), F.col("pair.p").alias("p")
    )


def true_probability(label: Column) -> Column:
    """Probability given to the true class; null for a class the model does not know."""
    return F.get(F.col("p"), (F.array_position("classes", label) - 1).cast("int"))


def log_loss(true: Column) -> Column:
    """Aggregate: mean of minus the log of the probability given to the true class.

    A class the model does not know has probability 0 and is scored by the clipping bound.
    """
    p = F.coalesce(true, F.lit(0.0))
    return exact_mean(-F.log(F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1.0 - EPSILON))))


def score(probabilities: DataFrame, label: str) -> DataFrame:
    """One row with the log loss and the number of rows scored."""
    return probabilities.agg(
        log_loss(true_probability(F.col(label))).alias("log_loss"), F.count(F.lit(1)).alias("n")
    )
