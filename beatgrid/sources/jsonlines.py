"""JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_to_json(df: DataFrame, column: str = "value") -> DataFrame:
    """One JSON object per row, as text; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(column))


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one JSON object per line."""
    rows_to_json(df).write.mode(mode).text(path)
