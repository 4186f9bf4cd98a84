"""From raw incidents to the feature table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.functions.categories import refine_category
from beatgrid.functions.dates import parse_date, parse_time, round_hour, season, time_of_day
from beatgrid.functions.places import block_or_junction, grid_number
from beatgrid.operators.columns import NOT_FEATURES
from beatgrid.operators.rows import exclude_categories, within_extent

# A feature row is complete exactly when these inputs are: every derived column is null only where
# one of them is. Testing inputs lets the test reach the scan, and derives each column once.
REQUIRED = (
    "IncidntNum",
    "Category",
    "DayOfWeek",
    "PdDistrict",
    "X",
    "Y",
    "Location",
    "PdId",
    "Address",
    "Dates",
    "Hour",
)


def decompose_dates(raw: DataFrame) -> DataFrame:
    """Parse the date and the time of day and split them into integers.

    Both come out of a one-row generator: tests and parts built on them use the parsed values, where plain
    columns would be copied into every filter and parsed again there.
    """
    both = F.struct(parse_date(F.col("Date")).alias("Dates"), parse_time(F.col("Time")).alias("_time"))
    parsed = raw.select("*", F.inline(F.array(both)))
    return parsed.select(
        "IncidntNum",
        "Category",
        "Descript",
        "Dates",
        "DayOfWeek",
        "PdDistrict",
        "Resolution",
        "Address",
        "X",
        "Y",
        "Location",
        "PdId",
        F.year("Dates").alias("Year"),
        F.month("Dates").alias("Month"),
        F.hour("_time").alias("Hour"),
        F.minute("_time").alias("Minute"),
        F.dayofmonth("Dates").alias("Day"),
    )


def add_features(incidents: DataFrame, bands: str = "as_written") -> DataFrame:
    """Add the derived columns to decomposed incidents."""
    hour = round_hour(F.col("Hour"), F.col("Minute"))
    return incidents.withColumns(
        {
            "Category_New": refine_category(F.col("Descript"), F.col("Category")),
            "GridNo": grid_number(F.col("X"), F.col("Y")),
            "BlockOrJunc": block_or_junction(F.col("Address")),
            "Hour": hour,
            "TimeOfDay": time_of_day(hour, bands),
            "Season": season(F.col("Month")),
        }
    )


def preprocess(incidents: DataFrame, bands: str = "as_written") -> DataFrame:
    """Complete feature rows of decomposed incidents; a missing resolution or description is no gap."""
    complete = reduce(and_, (F.col(name).isNotNull() for name in REQUIRED))
    return (
        incidents.transform(exclude_categories)
        .where(complete)
        .transform(add_features, bands)
        .drop(*NOT_FEATURES)
    )


def build_features(raw: DataFrame, bands: str = "as_written") -> DataFrame:
    """Feature table of raw incidents. Row-wise throughout, so batch and streaming input both work."""
    return raw.transform(decompose_dates).transform(within_extent).transform(preprocess, bands)
