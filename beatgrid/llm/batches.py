"""How many bytes go to a Python worker, and into a row group of a table, at a time."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"
GROUP_SIZE = "parquet.block.size"


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """What is run inside sends rows to Python in batches of a few MB, however long the texts are.

    The default is 64 MB a batch, which a task holds several times over outside of its heap. The caller's setting
    is back when the block ends.
    """
    with _setting(spark, BATCH_SIZE, size):
        yield


@contextmanager
def small_groups(spark: SparkSession, size: int = 8 << 20) -> Iterator[None]:
    """What is run inside writes tables in row groups of a few MB.

    The default is 128 MB, which the task that writes a group holds as a whole, and the task that reads it again.
    """
    with _setting(spark, GROUP_SIZE, str(size)):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
