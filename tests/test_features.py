from __future__ import annotations

import tempfile

import pytest

from beatgrid.operators import columns, rows
from beatgrid.plans.features import build_features, decompose_dates
from beatgrid.schemas import FEATURES, RAW_INCIDENTS
from beatgrid.sources.delimited import write_csv
from beatgrid.sources.incidents import incidents
from beatgrid.streaming.features import feature_stream, write_feature_stream

GOOD = dict(
    IncidntNum=1,
    Category="ROBBERY",
    Descript="ROBBERY, BODILY FORCE",
    DayOfWeek="Monday",
    Date="01/19/2015",
    Time="23:41",
    PdDistrict="MISSION",
    Resolution="NONE",
    Address="300 Block of OAK ST",
    X=-122.42,
    Y=37.76,
    Location="(37.76, -122.42)",
    PdId=100,
)


def raw(spark, *changes):
    return spark.createDataFrame([tuple((GOOD | change).values()) for change in changes], RAW_INCIDENTS)


def test_one_row(spark):
    row = build_features(raw(spark, {})).first().asDict()
    assert list(row) == FEATURES.fieldNames()
    assert (row["Year"], row["Month"], row["Day"], row["Hour"]) == (2015, 1, 19, 0)
    assert (row["TimeOfDay"], row["Season"], row["BlockOrJunc"]) == ("After Midnight", "Winter", 0)
    assert (row["Category_New"], row["GridNo"]) == ("ROBBERY", 20 * 13 + 18)


@pytest.mark.parametrize("name", [n for n in RAW_INCIDENTS.fieldNames() if n not in ("Resolution", "Descript")])
def test_a_missing_value_drops_the_row(spark, name):
    assert build_features(raw(spark, {name: None}, {"PdId": 7})).collect()[0]["PdId"] == 7
    assert build_features(raw(spark, {name: None})).count() == 0


@pytest.mark.parametrize("name", ["Resolution", "Descript"])
def test_a_missing_note_keeps_the_row(spark, name):
    assert build_features(raw(spark, {name: None})).count() == 1


@pytest.mark.parametrize(
    "change",
    [{"Date": "13/45/2015"}, {"Time": "25:00"}, {"Category": "NON-CRIMINAL"}, {"X": -122.3549}, {"X": -120.5}],
)
def test_rows_left_out(spark, change):
    assert build_features(raw(spark, change)).count() == 0


def test_split(spark):
    df = decompose_dates(raw(spark, {"Date": "12/31/2015"}, {"Date": "01/01/2016"}, {"Date": "bad"}))
    train, test = rows.split_by_year(df)
    assert [r["Year"] for r in train.collect()] == [2015] and [r["Year"] for r in test.collect()] == [2016]
    assert {(r["Year"], r["split"]) for r in rows.with_split(df).collect()} == {(2015, "train"), (2016, "test")}


def test_plan_has_no_python_and_one_scan(spark, folder):
    features = build_features(incidents(spark, folder))
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and plan.count("FileScan") == 1
    assert "o_totalprice" not in plan


def test_result_does_not_depend_on_partitions(spark, folder):
    source = incidents(spark, folder)
    assert build_features(source).exceptAll(build_features(source.repartition(7))).count() == 0


def test_column_tools(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "n int, s string, x double")
    assert columns.strings_then_numbers(df).columns == ["s", "n", "x"]
    assert columns.unpack(columns.pack(df, "row", "x"), "row").columns == ["n", "s", "x"]
    assert [tuple(r) for r in columns.schema_rows(df).collect()] == [(0, "n", "int"), (1, "s", "string"), (2, "x", "double")]
    assert columns.drop_columns(df, ("s", "absent")).columns == ["n", "x"]


def test_stream_equals_batch(spark, folder):
    scratch = tempfile.mkdtemp(prefix="beatgrid-stream-")
    source = incidents(spark, folder)
    write_csv(source.where("IncidntNum < 700"), f"{scratch}/raw", mode="append")
    write_feature_stream(feature_stream(spark, f"{scratch}/raw"), f"{scratch}/out", f"{scratch}/state").awaitTermination()
    write_csv(source.where("IncidntNum >= 700"), f"{scratch}/raw", mode="append")
    write_feature_stream(feature_stream(spark, f"{scratch}/raw"), f"{scratch}/out", f"{scratch}/state").awaitTermination()
    streamed = spark.read.schema(FEATURES).parquet(f"{scratch}/out").select(*FEATURES.fieldNames())
    batch = build_features(source)
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0
