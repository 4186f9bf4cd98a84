"""Sums and means of doubles that come out the same however rows are spread over tasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal places to which values enter a sum.
SUM_DIGITS = 10


def exact_sum(column: Column) -> Column:
    """Aggregate: the sum of a column in whole units of its last decimal place."""
    return F.sum(column.cast("double").cast(f"decimal(28, {SUM_DIGITS})"))


def exact_mean(column: Column) -> Column:
    """Aggregate: the mean over non-null values, from an exact sum."""
    return exact_sum(column).cast("double") / F.count(column)
