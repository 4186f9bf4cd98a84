from __future__ import annotations

import tempfile
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from beatgrid import session
from beatgrid.__main__ import main
from beatgrid.operators.rows import split_by_year
from beatgrid.plans.features import build_features
from beatgrid.plans.workflow import feature_job, feature_job_csv, model_job, profile_job, read_features
from beatgrid.schemas import FEATURES
from beatgrid.sources.delimited import read_csv, read_well_formed_csv, write_csv
from beatgrid.sources.incidents import incidents
from beatgrid.sources.jsonlines import write_json_lines

SCHEMA = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("v", T.IntegerType())]
)


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="beatgrid-test-")


def test_csv_round_trip_and_modes(spark, scratch):
    df = spark.createDataFrame([(1, 'a "quoted", text', 2), (2, None, None)], SCHEMA)
    path = f"{scratch}/csv"
    write_csv(df, path)
    assert sorted(read_csv(spark, path, SCHEMA).collect()) == sorted(df.collect())
    assert read_csv(spark, path).schema["v"].dataType == T.IntegerType()
    with pytest.raises(AnalysisException):
        write_csv(df, path)
    write_csv(df.limit(1), path, mode="overwrite", single_file=True)
    assert len(list(Path(path).glob("part-*"))) == 1 and read_csv(spark, path, SCHEMA).count() == 1


def test_a_header_in_another_order_is_refused(spark, scratch):
    Path(scratch, "a.csv").write_text("name,id,v\na,1,2\n")
    with pytest.raises(Exception, match="CSV header|header"):
        read_csv(spark, scratch, SCHEMA).collect()


def test_malformed_lines_do_not_depend_on_the_columns_used(spark, scratch):
    Path(scratch, "a.csv").write_text('id,name,v\n1,a,2\nx,b,3\n3,c\n4,"d,e",5\n5,f,6,7\n6,,\n')
    df = read_well_formed_csv(spark, scratch, SCHEMA)
    assert [row["id"] for row in df.orderBy("id").collect()] == [1, 4, 6]
    assert df.count() == 3 and df.select("name").count() == 3 and df.columns == ["id", "name", "v"]


def test_malformed_reader_checks_the_header(spark, scratch):
    Path(scratch, "a.csv").write_text("name,id,v\na,1,2\n")
    with pytest.raises(Exception, match="CSV header|header"):
        read_well_formed_csv(spark, scratch, SCHEMA).collect()


def test_quoted_headers_line_breaks_and_empty_texts(spark, scratch):
    Path(scratch, "a.csv").write_text('"id","name","v"\n1,"x\ny",2\n2,"",3\n3,\\N,4\n')
    for reader in (read_csv, read_well_formed_csv):
        rows = reader(spark, scratch, SCHEMA, multi_line=True).orderBy("id").collect()
        assert [tuple(r) for r in rows] == [(1, "x\ny", 2), (2, "", 3), (3, None, 4)]
    df = spark.createDataFrame([(1, "x\ny", 1), (2, "", 2), (3, None, 3)], SCHEMA)
    write_csv(df, f"{scratch}/back")
    assert read_csv(spark, f"{scratch}/back", SCHEMA, multi_line=True).orderBy("id").collect() == df.collect()


def test_lines_are_parsed_once(spark, scratch):
    Path(scratch, "a.csv").write_text("id,name,v\n1,a,2\nx,b,3\n")
    plan = read_well_formed_csv(spark, scratch, SCHEMA).select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1 and plan.count("Relation") == 1


def test_scratch_tables_are_removed(spark):
    with session.Scratch(spark) as scratch:
        kept = scratch.keep(spark.range(3), "numbers")
        assert kept.count() == 3
        path = Path(scratch.paths[0].removeprefix("file:"))
        assert path.is_dir()
    assert not path.exists()


def test_json_lines(spark, scratch):
    df = spark.createDataFrame([(1, "a/b", 2), (2, None, 3)], SCHEMA)
    write_json_lines(df, f"{scratch}/json")
    assert sorted(spark.read.schema(SCHEMA).json(f"{scratch}/json").collect(), key=lambda r: r["id"]) == df.collect()


def test_jobs_from_files_to_files(spark, scratch, folder):
    write_csv(incidents(spark, folder), f"{scratch}/raw")
    feature_job(spark, f"{scratch}/raw", f"{scratch}/features", last_train_year=1998)
    feature_job_csv(spark, f"{scratch}/raw", f"{scratch}/csv", last_train_year=1998)
    parts = split_by_year(build_features(incidents(spark, folder)), 1998)
    for name, expected in zip(("train", "test"), parts):
        stored = read_features(spark, f"{scratch}/features", name)
        assert stored.count() == expected.count() and stored.exceptAll(expected).count() == 0
        assert read_csv(spark, f"{scratch}/csv/{name}", FEATURES).exceptAll(expected).count() == 0
    pruned = read_features(spark, f"{scratch}/features", "train").where("Year = 1997")
    assert "PartitionFilters: [isnotnull(Year" in pruned._jdf.queryExecution().executedPlan().toString()
    train, test = (read_features(spark, f"{scratch}/features", name) for name in ("train", "test"))
    profile_job(train, test, f"{scratch}/profile")
    attached = spark.read.parquet(f"{scratch}/profile/test")
    assert attached.count() == test.count() and attached.columns == [*FEATURES.fieldNames(), "ndArray"]
    probabilities, score = model_job(train, test, trees=3, depth=3)
    assert probabilities.count() == test.count() and score.first()["log_loss"] > 0
    assert model_job(train, test, "one_hot", trees=3, depth=3)[1].first()["n"] == test.count()


class Context:
    """Stands in for the parts of a context that name a checkpoint folder."""

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder():
    def folder_for(setting, context):
        conf = SimpleNamespace(get=lambda key, default: setting if key == "spark.checkpoint.dir" else default)
        return session.shared_folder(SimpleNamespace(conf=conf, sparkContext=context))

    assert folder_for("hdfs://shared/c/", Context("yarn")) == "hdfs://shared/c"
    assert folder_for(None, Context("yarn", "hdfs://other")) == "hdfs://other"
    local = Context("local[8]")
    assert folder_for(None, local) == local.folder and Path(local.folder).is_dir()
    with pytest.raises(ValueError):
        folder_for(None, Context("yarn"))


def test_fresh_paths_differ(spark):
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_command_line(spark, scratch, folder):
    write_csv(incidents(spark, folder), f"{scratch}/raw")
    main(["features", f"{scratch}/raw", f"{scratch}/features", "--last-train-year", "1998"])
    main(["profile", f"{scratch}/features", f"{scratch}/profile"])
    main(["model", f"{scratch}/features", f"{scratch}/model", "--trees", "2", "--depth", "2"])
    assert spark.read.parquet(f"{scratch}/profile/train").count() > spark.read.parquet(f"{scratch}/profile/test").count()
    assert spark.read.parquet(f"{scratch}/model/score").first()["log_loss"] > 0
    assert spark.read.parquet(f"{scratch}/model/probabilities").select("class").distinct().count() == 15
