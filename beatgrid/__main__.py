"""Command line of the three jobs: ``python -m beatgrid features|profile|model``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from beatgrid.operators.evaluate import long_form
from beatgrid.plans.matrices import KEY
from beatgrid.plans.workflow import feature_job, model_job, profile_job, read_features


def main(arguments: Sequence[str] | None = None) -> None:
    """Run one job in the session that spark-submit (or the caller) has set up."""
    parser = argparse.ArgumentParser(prog="beatgrid")
    jobs = parser.add_subparsers(dest="job", required=True)
    features = jobs.add_parser("features", help="raw CSV files to the feature table")
    features.add_argument("raw")
    features.add_argument("out")
    features.add_argument("--last-train-year", type=int, default=2015)
    profile = jobs.add_parser("profile", help="feature table to rows with their grid profile")
    model = jobs.add_parser("model", help="feature table to class probabilities and their log loss")
    for job in (profile, model):
        job.add_argument("features")
        job.add_argument("out")
    model.add_argument("--encoding", choices=("label", "one_hot"), default="label")
    model.add_argument("--trees", type=int, default=700)
    model.add_argument("--depth", type=int, default=13)
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("beatgrid").getOrCreate()
    if chosen.job == "features":
        feature_job(spark, chosen.raw, chosen.out, chosen.last_train_year)
        return
    train, test = (read_features(spark, chosen.features, split) for split in ("train", "test"))
    if chosen.job == "profile":
        profile_job(train, test, chosen.out)
        return
    probabilities, score = model_job(train, test, chosen.encoding, chosen.trees, chosen.depth)
    long_form(probabilities, KEY).write.parquet(f"{chosen.out}/probabilities")
    score.write.parquet(f"{chosen.out}/score")


if __name__ == "__main__":
    main()
