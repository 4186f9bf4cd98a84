"""Array-valued features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(left: Column, right: Column) -> Column:
    """Element-wise quotient of two arrays of the same length."""
    return F.zip_with(left, right, lambda x, y: x.cast("double") / y)


def zeros(length: Column) -> Column:
    """Array of ``length`` zeros."""
    return F.array_repeat(F.lit(0.0), length)


def pad_right(values: Column, length: Column) -> Column:
    """``values`` followed by zeros up to ``length`` elements; longer arrays stay as they are."""
    missing = F.greatest(length - F.size(values), F.lit(0))
    return F.concat(values.cast("array<double>"), F.array_repeat(F.lit(0.0), missing))


def as_text(values: Column) -> Column:
    """Text form of an array, such as ``[0.1, 0.0]``."""
    return values.cast("string")
