"""Column selection and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns left out of the feature table, and of the two model matrices.
NOT_FEATURES = ("Resolution", "Descript", "Address", "Dates", "Minute")
NOT_IN_LABEL_ENCODED = (
    "Category_New",
    "Category",
    "Location",
    "PdId",
    "season_Spring",
    "season_Fall",
    "Year",
    "Day",
    "IncidntNum",
    "TimeOfDay",
)
NOT_IN_ONE_HOT = ("Category_New", "Category", "Location", "PdId", "Day", "IncidntNum", "TimeOfDay")
NOT_IN_REDUCED = ("Category_New", "season_Spring", "season_Fall", "Year", "X", "IncidntNum")
NOT_IN_SUMMER_FOREST = ("Category_New", "season_Spring", "season_Winter", "Year", "X")


def drop_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """All columns but ``names``; names that are absent do not matter."""
    return df.drop(*names)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns."""
    return [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    """Names of the string columns."""
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def strings_then_numbers(df: DataFrame) -> DataFrame:
    """String columns followed by numeric columns, one pass, no positional gluing."""
    return df.select(*string_columns(df), *numeric_columns(df))


def schema_rows(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    fields = [(position, f.name, f.dataType.simpleString()) for position, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(fields, "position int, name string, type string")


def pack(df: DataFrame, name: str, *extra: str) -> DataFrame:
    """All columns but ``extra`` in one struct column ``name``, next to the ``extra`` columns."""
    inner = [column for column in df.columns if column not in extra]
    return df.select(F.struct(*inner).alias(name), *extra)


def unpack(df: DataFrame, name: str) -> DataFrame:
    """Fields of the struct column ``name`` as columns, followed by the other columns."""
    others = [column for column in df.columns if column != name]
    return df.select(f"{name}.*", *others)
