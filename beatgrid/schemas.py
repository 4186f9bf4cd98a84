"""Explicit schemas of the stages; inference stays opt-in."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_INCIDENTS = T.StructType(
    [
        T.StructField("IncidntNum", T.LongType()),
        T.StructField("Category", T.StringType()),
        T.StructField("Descript", T.StringType()),
        T.StructField("DayOfWeek", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("Time", T.StringType()),
        T.StructField("PdDistrict", T.StringType()),
        T.StructField("Resolution", T.StringType()),
        T.StructField("Address", T.StringType()),
        T.StructField("X", T.DoubleType()),
        T.StructField("Y", T.DoubleType()),
        T.StructField("Location", T.StringType()),
        T.StructField("PdId", T.LongType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("IncidntNum", T.LongType()),
        T.StructField("Category", T.StringType()),
        T.StructField("DayOfWeek", T.StringType()),
        T.StructField("PdDistrict", T.StringType()),
        T.StructField("X", T.DoubleType()),
        T.StructField("Y", T.DoubleType()),
        T.StructField("Location", T.StringType()),
        T.StructField("PdId", T.LongType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("Hour", T.IntegerType()),
        T.StructField("Day", T.IntegerType()),
        T.StructField("Category_New", T.StringType()),
        T.StructField("GridNo", T.LongType()),
        T.StructField("BlockOrJunc", T.IntegerType()),
        T.StructField("TimeOfDay", T.StringType()),
        T.StructField("Season", T.StringType()),
    ]
)
