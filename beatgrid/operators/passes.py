"""Sums of arrays over the tasks of one pass, for models that are fitted by many passes over stored rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Decimal places to which a task's doubles enter a sum.
PASS_DIGITS = 12
#: Tasks whose whole numbers the driver adds up itself; a pass then has one stage in place of two.
FEW_TASKS = 32
#: Rows stored as one: passes then read a few long values instead of many short ones.
BLOCK_ROWS = 8_192


def summed(
    rows: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
    size: int,
    whole: bool = False,
    tasks: int = FEW_TASKS + 1,
) -> np.ndarray:
    """The element-wise sum over all tasks of the array of ``size`` numbers that ``work`` makes of a task's batches.

    Each task sends the places that are not zero, and those are added up by place, so the driver gets ``size``
    numbers however many tasks there are. ``whole`` numbers are added as they are, doubles as exact decimals: the
    order in which tasks end does not matter. Whole numbers of at most ``FEW_TASKS`` tasks, where that is known, are
    added by the driver.
    """
    kind = "bigint" if whole else "double"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = work(batches).ravel()
        place = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(own[place])], names=["place", "value"])

    parts = rows.mapInArrow(sums, f"place bigint, value {kind}")
    if not whole or tasks > FEW_TASKS:
        value = F.col("value") if whole else F.col("value").cast(f"decimal(38, {PASS_DIGITS})")
        parts = parts.groupBy("place").agg(F.sum(value).cast(kind).alias("value"))
    found = parts.toArrow()
    out = np.zeros(size, np.int64 if whole else np.float64)
    np.add.at(out, found.column("place").to_numpy(), found.column("value").to_numpy())
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of lists of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks(
    rows: DataFrame, names: Sequence[str], arrays: Callable[[pa.RecordBatch], Sequence[np.ndarray]]
) -> DataFrame:
    """All rows, up to ``BLOCK_ROWS`` of them in one: a binary column for each array that ``arrays`` makes of them."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                found = arrays(batch.slice(start, BLOCK_ROWS))
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in found], names=list(names))

    return rows.mapInArrow(packed, ", ".join(f"{name} binary" for name in names))


def unpacked(batches: Iterator[pa.RecordBatch], *kinds: type) -> Iterator[list[np.ndarray]]:
    """The arrays of each block, one of each kind; they are read where they lie."""
    for batch in batches:
        for row in range(batch.num_rows):
            yield [np.frombuffer(column[row].as_buffer(), kind) for column, kind in zip(batch.columns, kinds)]
