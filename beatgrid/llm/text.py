"""Words and lines as column expressions, and names that cannot clash with a caller's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that part words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text in order; no words for a null text."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(parts, lambda part: part != "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character as it is, whatever the locale."""
    return F.translate(text, CAPITALS, SMALL)


class Callers:
    """A caller's columns under names that no column of an operator has; the ``used`` ones keep theirs."""

    def __init__(self, df: DataFrame, *used: str) -> None:
        self.names = {name: name if name in used else f"own{i}" for i, name in enumerate(df.columns)}
        self.df = df.select(*(F.col(f"`{name}`").alias(own) for name, own in self.names.items()))

    def columns(self, **instead: Column) -> list[Column]:
        """The caller's columns under their names again, some (in any case) with another value."""
        new = {name.lower(): column for name, column in instead.items()}
        return [new.get(name.lower(), F.col(own)).alias(name) for name, own in self.names.items()]

    def others(self, *results: str) -> list[Column]:
        """The caller's columns but those named like a result, in any case."""
        taken = {name.lower() for name in results}
        return [F.col(own).alias(name) for name, own in self.names.items() if name.lower() not in taken]


def with_result(df: DataFrame, **columns: Column) -> DataFrame:
    """Add result columns; a caller's column of the same name (in any case) gives way to the result."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *(column.alias(name) for name, column in columns.items()))
