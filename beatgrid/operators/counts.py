"""Counts, distinct values and means. Every count is combined before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.sums import exact_mean


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per distinct combination of ``columns``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def category_counts(df: DataFrame) -> DataFrame:
    """Incidents per category."""
    return value_counts(df, "Category_New")


def grid_category_counts(df: DataFrame) -> DataFrame:
    """Incidents per grid cell and category."""
    return value_counts(df, "GridNo", "Category_New")


def grid_category_pivot(df: DataFrame, categories: list[str]) -> DataFrame:
    """Incidents per grid cell, one column per category."""
    per_category = [
        F.coalesce(F.sum(F.when(F.col("Category_New") == name, F.col("n"))), F.lit(0)).alias(name)
        for name in categories
    ]
    return grid_category_counts(df).groupBy("GridNo").agg(*per_category)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of ``columns``."""
    return df.select(*columns).distinct()


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """One row with the number of distinct values of each column.

    All values are made distinct in one pass as (column, value) pairs, so no pass per column and no
    expansion inside the aggregation is needed.
    """
    pairs = column_values(df, *columns).distinct()
    per_column = [F.count(F.when(F.col("column") == name, 1)).alias(name) for name in columns]
    return pairs.where(F.col("value").isNotNull()).agg(*per_column)


def column_values(df: DataFrame, *columns: str) -> DataFrame:
    """(column, value) pairs of the named columns, values as text."""
    pairs = [F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")) for name in columns]
    return df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")


def non_null_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null rows per value of ``column``; the null group itself counts zero."""
    return df.groupBy(column).agg(F.count(column).alias("n"))


def column_means(df: DataFrame, *columns: str) -> DataFrame:
    """One row with the mean of each column."""
    means: list[Column] = [exact_mean(F.col(name)).alias(name) for name in columns]
    return df.agg(*means)
