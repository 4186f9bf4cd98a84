from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from beatgrid.functions import arrays, categories, dates, places


def values(df, column="v"):
    return [row[column] for row in df.collect()]


def test_round_hour_and_bands_for_every_hour(spark):
    rows = [(h, m) for h in range(24) for m in (0, 40, 41, 59)]
    hour = dates.round_hour(F.col("h"), F.col("m"))
    found = (
        spark.createDataFrame(rows, "h int, m int")
        .select("h", "m", hour.alias("r"), dates.time_of_day(hour).alias("w"), dates.time_of_day(hour, "intended").alias("i"))
        .collect()
    )
    written = dict.fromkeys(range(24), "Night") | dict.fromkeys((0, 1, 2), "After Midnight")
    written |= dict.fromkeys(range(4, 8), "Dawn") | dict.fromkeys(range(11, 24), "Morning")
    intended = ["After Midnight"] * 3 + ["Dawn"] * 5 + ["Morning"] * 4 + ["Afternoon"] * 5 + ["Evening"] * 4 + ["Night"] * 3
    for row in found:
        expected = row["h"] if row["m"] <= 40 else (row["h"] + 1) % 24
        assert row["r"] == expected
        assert row["w"] == written[expected]
        assert row["i"] == intended[expected]


def test_season_of_every_month(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int").select(dates.season(F.col("m")).alias("v"))
    assert values(df) == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(None, None, None)], "n int, t string, x double").select(
        dates.round_hour(F.col("n"), F.col("n")),
        dates.time_of_day(F.col("n")),
        dates.season(F.col("n")),
        dates.parse_date(F.col("t")),
        dates.parse_time(F.col("t")),
        places.block_or_junction(F.col("t")),
        places.address_street(F.col("t")),
        places.grid_number(F.col("x"), F.lit(37.7)),
        places.grid_number(F.lit(-122.5), F.col("x")),
    )
    assert set(df.first()) == {None}


@pytest.mark.parametrize("text", ["13/45/2015", "2015-01-19", "", "soon"])
def test_unreadable_dates_are_null(spark, text):
    assert values(spark.createDataFrame([(text,)], "t string").select(dates.parse_date(F.col("t")).alias("v"))) == [None]


def test_dates_and_times(spark):
    df = spark.createDataFrame([("01/19/2015", "14:05")], "d string, t string")
    day, time = dates.parse_date(F.col("d")), dates.parse_time(F.col("t"))
    row = df.select(F.year(day), F.month(day), F.dayofmonth(day), F.hour(time), F.minute(time)).first()
    assert tuple(row) == (2015, 1, 19, 14, 5)


RULE_CASES = [
    ("EXPIRED LICENSE", "OTHER", "TRAFFIC VIOLATION"),
    ("TRAFFIC COLLISION", "OTHER", "TRAFFIC VIOLATION"),
    ("SPEEDING", "OTHER", "TRAFFIC VIOLATION"),
    ("DRIVING UNDER THE INFLUENCE OF ALCOHOL", "OTHER", "TRAFFIC VIOLATION"),
    ("POSSESSION OF BURGLARY TOOLS", "OTHER", "DEADLY TOOL POSSESSION"),
    ("AIR GUN", "OTHER", "DEADLY TOOL POSSESSION"),
    ("TEAR GAS", "OTHER", "DEADLY TOOL POSSESSION"),
    ("WEAPON", "OTHER", "DEADLY TOOL POSSESSION"),
    ("NEUTRAL", "WEAPON LAWS", "DEADLY TOOL POSSESSION"),
    ("SEXUAL BATTERY", "OTHER", "SEXUAL OFFENSES"),
    ("NEUTRAL", "SEX OFFENSES, FORCIBLE", "SEXUAL OFFENSES"),
    ("FORGERY", "OTHER", "FRAUD/COUNTERFEITING"),
    ("CREDIT CARD, FRAUD", "OTHER", "FRAUD/COUNTERFEITING"),
    ("NEUTRAL", "BAD CHECKS", "FRAUD/COUNTERFEITING"),
    ("NEUTRAL", "FORGERY/COUNTERFEITING", "FRAUD/COUNTERFEITING"),
    ("NEUTRAL", "EMBEZZLEMENT", "FRAUD/COUNTERFEITING"),
    ("TOBACCO", "OTHER", "DRUG/NARCOTIC"),
    ("DRUG PARAPHERNALIA", "OTHER", "DRUG/NARCOTIC"),
    ("INDECENT EXPOSURE", "OTHER", "PORNOGRAPHY/OBSCENE MAT"),
    ("OBSCENE CALLS", "OTHER", "PORNOGRAPHY/OBSCENE MAT"),
    ("DISORDERLY CONDUCT", "OTHER", "PORNOGRAPHY/OBSCENE MAT"),
    ("DOMESTIC VIOLENCE", "OTHER", "DOMESTIC VIOLENCE"),
    ("NEUTRAL", "SUSPICIOUS OCC", "SUSPICIOUS PERSON/ACT"),
    ("NEUTRAL", "TREA", "LOITERING"),
    ("NEUTRAL", "WARRANTS", "WARRANT ISSUED"),
    ("NEUTRAL", "VANDALISM", "ARSON"),
    ("HARASSING CALLS", "OTHER", "ASSAULT"),
    ("NEUTRAL", "FAMILY OFFENSES", "ASSAULT"),
    ("UNDER INFLUENCE OF ALCOHOL", "OTHER", "DRUKENNESS"),
    ("under influence of alcohol", "OTHER", "OTHER"),
    ("NEUTRAL", "ROBBERY", "ROBBERY"),
    (None, "ROBBERY", "ROBBERY"),
    (None, "VANDALISM", "ARSON"),
    ("WEAPON", "SEX OFFENSES", "DEADLY TOOL POSSESSION"),
]


def test_category_rules(spark):
    df = spark.createDataFrame(RULE_CASES, "d string, c string, expected string")
    refined = categories.refine_category(F.col("d"), F.col("c"))
    for row in df.select("*", refined.alias("v")).collect():
        assert row["v"] == row["expected"], row


def test_addresses(spark):
    rows = [("A ST / B ST",), ("300 Block of OAK ST",), ("PIER 39",), ("1 Block of X Block of Y",)]
    df = spark.createDataFrame(rows, "a string").select(
        places.block_or_junction(F.col("a")).alias("kind"), places.address_street(F.col("a")).alias("street")
    )
    assert [tuple(row) for row in df.collect()] == [(1, "A ST "), (0, " OAK ST"), (0, None), (0, " X ")]


def test_grid_corners_and_outside(spark):
    rows = [
        (-123.0137, 37.6040, 0),
        (-123.0137 + 1.5 * places.CELL_WIDTH, 37.6040, 1),
        (-122.36, 37.6040, 19),
        (-123.0137, 37.6040 + 1.5 * places.CELL_HEIGHT, 20),
        (-122.36, 37.83, 399),
        (-123.0, 37.59, -40),
        (-123.0, 37.9, 500),
    ]
    df = spark.createDataFrame(rows, "x double, y double, n bigint")
    found = df.select("n", places.grid_number(F.col("x"), F.col("y")).alias("v")).collect()
    assert [row["v"] for row in found] == [row["n"] for row in found]


def test_arrays(spark):
    df = spark.createDataFrame([([1, 2], [4, 8])], "a array<bigint>, b array<bigint>").select(
        arrays.divide(F.col("a"), F.col("b")).alias("q"),
        arrays.zeros(F.lit(3)).alias("z"),
        arrays.pad_right(F.col("a"), F.lit(4)).alias("p"),
        arrays.pad_right(F.col("a"), F.lit(1)).alias("same"),
        arrays.as_text(arrays.divide(F.col("a"), F.lit([10, 1]).cast("array<bigint>"))).alias("t"),
    )
    row = df.first()
    assert row["q"] == [0.25, 0.25] and row["z"] == [0.0] * 3
    assert row["p"] == [1.0, 2.0, 0.0, 0.0] and row["same"] == [1.0, 2.0] and row["t"] == "[0.1, 2.0]"
