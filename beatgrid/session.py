"""Session helpers: the shared folder for intermediate tables, and sizes that need an action."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session without that setting may have named a checkpoint folder itself. Where there is neither,
    a temporary folder stands in for it on a local master only (tests, laptops); on a cluster that is
    an error rather than a machine-local folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="beatgrid-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has handed out."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a shared Parquet table and return the scan of it.

    Cuts lineage, survives lost executors, and lets later reads prune columns.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Intermediate tables of one piece of work: written like :func:`materialize`, removed when the block ends.

    What is returned from the block must not read them any more; materialize it first.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *problem) -> None:
        for path in self.paths:
            remove(self.spark, path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
