"""Probability of each grid cell given a category, as a vector per cell and a feature per row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.arrays import zeros
from beatgrid.operators.counts import grid_category_counts
from beatgrid.operators.lookup import BROADCAST_BYTES, left_lookup
from beatgrid.session import materialize


@dataclass(frozen=True)
class GridProfile:
    """Counts per (grid cell, category) of the training rows, and what follows from them.

    The counts are the only thing kept: one row per pair that occurs, whatever the number of
    incidents. Vectors have one element per training category, in ascending order of names.
    """

    counts: DataFrame

    def totals(self) -> DataFrame:
        """Training rows per category."""
        return self.counts.groupBy("Category_New").agg(F.sum("n").alias("n"))

    def _totals_array(self) -> Column:
        pairs = F.collect_list(F.struct("Category_New", "n"))
        return self.totals().agg(F.array_sort(pairs)).scalar()

    def _per_grid(self) -> DataFrame:
        """One row per cell with its counts as a map; at most one entry per category."""
        entries = F.collect_list(F.struct("Category_New", "n"))
        return (
            self.counts.groupBy("GridNo")
            .agg(F.map_from_entries(entries).alias("counts"))
            .withColumn("totals", self._totals_array())
        )

    def arrays(self) -> DataFrame:
        """(GridNo, category names, cell counts with zeros filled in, category totals) as arrays."""
        fill = F.transform(
            "totals", lambda t: F.coalesce(F.try_element_at("counts", t["Category_New"]), F.lit(0))
        )
        return self._per_grid().select(
            "GridNo",
            F.transform("totals", lambda t: t["Category_New"]).alias("categories"),
            fill.alias("counts"),
            F.transform("totals", lambda t: t["n"]).alias("totals"),
        )

    def vectors(self) -> DataFrame:
        """(GridNo, p): P(cell | category) for every category."""
        quotient = F.transform(
            "totals",
            lambda t: F.coalesce(F.try_element_at("counts", t["Category_New"]), F.lit(0)).cast("double") / t["n"],
        )
        return self._per_grid().select("GridNo", quotient.alias("p"))

    def long(self) -> DataFrame:
        """(GridNo, Category_New, p), every cell with every category."""
        pairs = F.transform(
            "totals",
            lambda t: F.struct(
                t["Category_New"].alias("Category_New"),
                (
                    F.coalesce(F.try_element_at("counts", t["Category_New"]), F.lit(0)).cast("double") / t["n"]
                ).alias("p"),
            ),
        )
        return self._per_grid().select("GridNo", F.explode(pairs).alias("pair")).select("GridNo", "pair.*")

    def missing(self) -> DataFrame:
        """(GridNo, Category_New) pairs that never occur in training."""
        absent = F.array_except(
            F.transform("totals", lambda t: t["Category_New"]), F.map_keys("counts")
        )
        return self._per_grid().select("GridNo", F.explode(absent).alias("Category_New"))

    def filled_counts(self) -> DataFrame:
        """Counts as doubles with a zero row appended for each pair that never occurs."""
        occurring = self.counts.select("GridNo", "Category_New", F.col("n").cast("double").alias("n"))
        return occurring.unionByName(self.missing().withColumn("n", F.lit(0.0)))

    def size_bytes(self) -> int:
        """Bytes of the vector table; one small job over the counts."""
        sizes = self.counts.agg(
            F.count_distinct("GridNo").alias("grids"), F.count_distinct("Category_New").alias("categories")
        ).first()
        return sizes["grids"] * (64 + 8 * sizes["categories"])

    def attach(self, rows: DataFrame, column: str = "ndArray", limit: int = BROADCAST_BYTES) -> DataFrame:
        """``rows`` with the vector of their cell; a cell unseen in training gets zeros."""
        table = self.vectors().withColumnRenamed("p", column)
        joined = left_lookup(rows, table, "GridNo", self.size_bytes(), limit)
        length = self.totals().agg(F.count(F.lit(1)).cast("int")).scalar()
        filled = F.coalesce(F.col(column), zeros(length))
        return joined.select(*rows.columns, filled.alias(column))


def fit_profile(train: DataFrame) -> GridProfile:
    """Count the training rows per cell and category in one pass and keep the counts as a table."""
    return GridProfile(materialize(grid_category_counts(train), "grid-counts"))
