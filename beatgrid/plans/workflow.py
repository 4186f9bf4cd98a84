"""The three jobs of the workflow, from files to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beatgrid.operators.classifiers import predict_proba, random_forest, training_rows
from beatgrid.operators.evaluate import score
from beatgrid.operators.profile import fit_profile
from beatgrid.operators.rows import split_by_year, with_split
from beatgrid.plans.features import build_features
from beatgrid.plans.matrices import FORESTS, KEY, LABEL, label_encoded_matrices, one_hot_matrices
from beatgrid.schemas import FEATURES, RAW_INCIDENTS
from beatgrid.sources.delimited import read_csv, write_csv


def feature_job(spark: SparkSession, raw_path: str, out: str, last_train_year: int = 2015) -> None:
    """Raw incidents in CSV files to one feature table with the folders ``split=train`` and ``split=test``.

    One pass over the raw files writes both parts; below each part there is one folder per year.
    """
    features = build_features(read_csv(spark, raw_path, RAW_INCIDENTS))
    rows = with_split(features, last_train_year).hint("rebalance", "split", "Year")
    rows.write.mode("overwrite").partitionBy("split", "Year").parquet(out)


def read_features(spark: SparkSession, out: str, split: str) -> DataFrame:
    """One part of the table written by ``feature_job``."""
    return spark.read.schema(FEATURES).parquet(f"{out}/split={split}").select(*FEATURES.fieldNames())


def feature_job_csv(
    spark: SparkSession, raw_path: str, out: str, last_train_year: int = 2015, single_file: bool = False
) -> None:
    """Raw incidents in CSV files to the CSV folders ``<out>/train`` and ``<out>/test``."""
    features = build_features(read_csv(spark, raw_path, RAW_INCIDENTS))
    for name, part in zip(("train", "test"), split_by_year(features, last_train_year)):
        write_csv(part, f"{out}/{name}", mode="overwrite", single_file=single_file)


def profile_job(train: DataFrame, test: DataFrame, out: str) -> None:
    """Attach the grid profile of the training rows to both parts; refuses existing output."""
    profile = fit_profile(train)
    for name, rows in (("train", train), ("test", test)):
        profile.attach(rows).write.parquet(f"{out}/{name}")


def model_job(
    train: DataFrame, test: DataFrame, encoding: str = "label", trees: int = 700, depth: int = 13
) -> tuple[DataFrame, DataFrame]:
    """Fit a random forest; (class probabilities of the test rows, their log loss)."""
    build = {"label": label_encoded_matrices, "one_hot": one_hot_matrices}[encoding]
    data = build(train, test).stored(FORESTS)
    model = random_forest(trees, depth).fit(training_rows(data.train, data.features, LABEL, data.classes))
    probabilities = predict_proba(model, data.test, data.features, data.classes, KEY, LABEL)
    return probabilities, score(probabilities, LABEL)
