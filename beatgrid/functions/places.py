"""Grid cells and addresses. Null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extent of the city and the number of cells along each side.
LONGITUDE_MIN = -123.0137
LONGITUDE_MAX = -122.3549
LATITUDE_MIN = 37.6040
LATITUDE_MAX = 37.8324
CELLS_PER_SIDE = 20

# Marks inside an address.
JUNCTION_MARK = "/"
BLOCK_MARK = "Block of"

CELL_WIDTH = (LONGITUDE_MAX - LONGITUDE_MIN) / CELLS_PER_SIDE
CELL_HEIGHT = (LATITUDE_MAX - LATITUDE_MIN) / CELLS_PER_SIDE


def grid_number(longitude: Column, latitude: Column) -> Column:
    """Row-major cell number. Not clamped: points outside the extent share numbers with other cells."""
    column = F.floor((longitude - LONGITUDE_MIN) / CELL_WIDTH)
    row = F.floor((latitude - LATITUDE_MIN) / CELL_HEIGHT)
    return (row * CELLS_PER_SIDE + column).cast("bigint")


def block_or_junction(address: Column) -> Column:
    """1 for a street junction, 0 for a block."""
    return address.contains(JUNCTION_MARK).cast("int")


def address_street(address: Column) -> Column:
    """First street of a junction, or what follows the block number; null where there is neither."""
    return F.when(
        address.contains(JUNCTION_MARK), F.split_part(address, F.lit(JUNCTION_MARK), F.lit(1))
    ).when(address.contains(BLOCK_MARK), F.split_part(address, F.lit(BLOCK_MARK), F.lit(2)))
