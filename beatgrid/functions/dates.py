"""Dates, times and the bands derived from them. Null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Input formats, rounding threshold, band and season names with their bounds.
DATE_FORMAT = "MM/dd/yyyy"
TIME_FORMAT = "HH:mm"
ROUND_UP_AFTER_MINUTE = 40
HOURS_PER_DAY = 24
BANDS_AS_WRITTEN = (("After Midnight", 0, 2), ("Dawn", 4, 7), ("Morning", 11, None))
BANDS_INTENDED = (
    ("After Midnight", 0, 2),
    ("Dawn", 3, 7),
    ("Morning", 8, 11),
    ("Afternoon", 12, 16),
    ("Evening", 17, 20),
)
OTHER_BAND = "Night"
SEASON_MONTHS = (("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)))
OTHER_SEASON = "Fall"


def parse_date(text: Column) -> Column:
    """Date of an ``MM/dd/yyyy`` text, null where it cannot be read."""
    return F.to_date(F.try_to_timestamp(text, F.lit(DATE_FORMAT)))


def parse_time(text: Column) -> Column:
    """Timestamp whose hour and minute come from an ``HH:mm`` text, null where it cannot be read."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def round_hour(hour: Column, minute: Column) -> Column:
    """Hour, moved to the next one late in the hour; wraps at midnight and leaves the day alone."""
    late = (minute > ROUND_UP_AFTER_MINUTE).cast("int")
    return ((hour + late) % HOURS_PER_DAY).cast("int")


def time_of_day(hour: Column, bands: str = "as_written") -> Column:
    """Band name of an hour.

    ``as_written`` keeps the bands of the established data sets, where everything from 11 on is
    Morning and the gaps are Night; ``intended`` is the gap-free reading of the same names.
    """
    table = {"as_written": BANDS_AS_WRITTEN, "intended": BANDS_INTENDED}[bands]
    name = F.when(hour.isNull(), F.lit(None).cast("string"))
    for label, low, high in table:
        inside = hour >= low if high is None else hour.between(low, high)
        name = name.when(inside, label)
    return name.otherwise(OTHER_BAND)


def season(month: Column) -> Column:
    """Season name of a month number."""
    name = F.when(month.isNull(), F.lit(None).cast("string"))
    for label, months in SEASON_MONTHS:
        name = name.when(month.isin(*months), label)
    return name.otherwise(OTHER_SEASON)
