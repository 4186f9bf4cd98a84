"""Row filters, splits, previews and row-count checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.categories import EXCLUDED_CATEGORIES
from beatgrid.functions.places import LONGITUDE_MAX


def exclude_categories(df: DataFrame, excluded: tuple[str, ...] = EXCLUDED_CATEGORIES) -> DataFrame:
    """Rows of other categories; a row without a category goes too."""
    return df.where(~F.col("Category").isin(*excluded))


def within_extent(df: DataFrame, longitude_max: float = LONGITUDE_MAX) -> DataFrame:
    """Rows strictly west of ``longitude_max``; a row without a longitude goes too."""
    return df.where(F.col("X") < longitude_max)


def split_by_year(df: DataFrame, last_train_year: int = 2015) -> tuple[DataFrame, DataFrame]:
    """Rows up to a year, and the later ones; a row without a year is in neither part."""
    return df.where(F.col("Year") <= last_train_year), df.where(F.col("Year") > last_train_year)


def with_split(df: DataFrame, last_train_year: int = 2015) -> DataFrame:
    """Both parts in one pass, told apart by a ``split`` column."""
    part = F.when(F.col("Year") <= last_train_year, "train").otherwise("test")
    return df.where(F.col("Year").isNotNull()).withColumn("split", part)


def drop_null_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without a null, in ``columns`` or anywhere."""
    return df.dropna("any", subset=list(columns) or None)


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in a stated order (a per-task top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def row_count_check(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with both row counts and whether they agree."""
    counts = left.agg(F.count(F.lit(1)).alias("n_left")).withColumn(
        "n_right", right.agg(F.count(F.lit(1))).scalar()
    )
    return counts.withColumn("ok", F.col("n_left") == F.col("n_right"))
