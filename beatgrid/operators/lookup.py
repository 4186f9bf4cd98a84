"""Joins of a large table with a lookup table of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def left_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_bytes: int,
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """``rows`` with the columns of the matching ``lookup`` row; every row is kept.

    A lookup known to fit is broadcast, which moves no row of the large side. A larger one is
    shuffled, with each key spread over ``salts`` tasks so that a hot key cannot fill one task; the
    salt is computed from the row, so a task that runs twice sends its rows to the same place.
    """
    if lookup_bytes <= limit:
        return rows.join(F.broadcast(lookup), key, "left")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*(F.col(f"`{name}`") for name in rows.columns)), F.lit(salts)))
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    copies = lookup.withColumn("_salt", F.explode(every_salt))
    return salted.join(copies.hint("merge"), [key, "_salt"], "left").drop("_salt")
