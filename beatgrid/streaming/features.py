"""The feature job over files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from beatgrid.plans.features import build_features
from beatgrid.schemas import RAW_INCIDENTS


def feature_stream(spark: SparkSession, raw_path: str) -> DataFrame:
    """Feature rows of raw incident CSV files as they arrive. Row-wise, so no state and no watermark."""
    raw = spark.readStream.schema(RAW_INCIDENTS).option("header", True).option("enforceSchema", False).csv(raw_path)
    return build_features(raw)


def write_feature_stream(features: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a Parquet table with one folder per year, then stop."""
    return (
        features.writeStream.format("parquet")
        .partitionBy("Year")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
