"""Line dedup against levelled sorted runs of line hashes.

Documents come in batches of ascending doc_id. A batch's line keys are reduced to the smallest and the largest doc_id
holding each, and joined with the runs of all earlier batches, which tells the keys that are known; the result is added
as a run on level 0, and a level that holds ``fanout`` runs is merged into one run of the next. Runs are tables in
buckets by key, sorted within, so a new batch meets them bucket by bucket: its own keys are shuffled, the runs are not.
A line is dropped if its key stands in an earlier run, or if a smaller doc_id of its own batch holds it.

There are at least ``BATCHES`` batches, and so many that each has at most ``BATCH_BYTES`` of text. Only 128-bit hashes,
doc_ids and line numbers are shuffled. Keys are combined before the shuffle, so a line that stands in every document
costs one row per task there; its occurrences then learn what is decided spread over ``SALTS`` tasks by a hash of
their document. Texts are shuffled once, to meet their dropped lines.

Defined results: a null text counts as one empty line and stays null in :func:`without_repeated_lines`; rows of
one doc_id are one document, so they do not repeat each other's lines; a null doc_id is no document to compare
with, its lines all stay; an empty table gives an empty table. Other columns pass through; one named like a
result column gives way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.llm.batches import small_batches
from beatgrid.llm.hashing import signed
from beatgrid.llm.text import Callers
from beatgrid.session import Scratch, fresh_path, materialize, remove

SPACES = b" \t\n\r\x0b\x0c"
LEAST_LENGTH = 10
BATCHES = 4
BATCH_BYTES = 256 << 30
SALTS = 8
FANOUT = 2
KEYS = ["h1", "h2"]
OCCURRENCE = "doc_id bigint, body bigint, line int, h1 bigint, h2 bigint"


class LineRuns:
    """Runs of line keys, level by level: tables of the shared folder in buckets by key."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def write(self, keys: DataFrame) -> str:
        """A table of rows dealt into buckets and sorted by key."""
        path = fresh_path(self.spark, "line-run")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        dealt = keys.repartition(self.buckets, *KEYS)
        dealt.write.bucketBy(self.buckets, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name

    def known(self, keys: DataFrame) -> DataFrame:
        """Adds ``known``: whether a run has the key."""
        found = F.lit(False)
        for i, name in enumerate(name for level in self.levels for name in level):
            run = self.spark.table(name).select(*KEYS, F.lit(True).alias(f"in{i}"))
            keys = keys.join(run, KEYS, "left")
            found = found | F.coalesce(f"in{i}", F.lit(False))
        return keys.select(*KEYS, "first", "last", found.alias("known"))

    def settle(self, run: str) -> None:
        """Put a run on level 0 and merge levels that are full."""
        level = 0
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0]).select(*KEYS)
            for name in full[1:]:
                merged = merged.unionByName(self.spark.table(name).select(*KEYS))
            run, level = self.write(merged.distinct()), level + 1
            for name in full:
                self._drop(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self.paths.pop(name))

    def clear(self) -> None:
        for name in list(self.paths):
            self._drop(name)
        self.levels = []


def _body() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def occurrences(documents: DataFrame) -> DataFrame:
    """One row per line whose key is long enough: its document, place and 128-bit key hash."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, body, text in zip(batch["doc_id"], batch["body"], batch["text"]):
                for number, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
                    key = line.strip(SPACES).lower()
                    if len(key) < LEAST_LENGTH or len(key.decode("utf-8", "surrogatepass")) < LEAST_LENGTH:
                        continue
                    rows.append((doc_id, body, number, *signed(key, 16)))
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=["doc_id", "body", "line", *KEYS])
                    rows = []
            yield pd.DataFrame(rows, columns=["doc_id", "body", "line", *KEYS])

    named = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return named.select("doc_id", _body().alias("body"), "text").mapInPandas(lines, OCCURRENCE)


def batch_state(own: DataFrame, runs: LineRuns) -> DataFrame:
    """(key, first, last, known) of a batch: the documents that hold a key, and whether an earlier batch has it."""
    first = own.groupBy(*KEYS).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return runs.known(first.repartition(runs.buckets, *KEYS))


def _bounds(documents: DataFrame, batches: int, batch_bytes: int) -> list:
    """doc_ids after which the next batch begins."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(batches, -(-size // batch_bytes))
    steps = [k / batches for k in range(1, batches)]
    found = documents.agg(F.percentile_approx("doc_id", steps, 10_000)).first()[0] if steps else None
    return sorted(set(found or []))


def dropped_lines(
    documents: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """(doc_id, body, dropped): the numbers of the lines to drop, for documents that lose any."""
    spark = documents.sparkSession
    bounds = _bounds(documents, batches, batch_bytes)
    batch = F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)
    salt = F.pmod(F.xxhash64("doc_id", "line"), F.lit(SALTS))
    every_salt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt")
    with Scratch(spark) as scratch, small_batches(spark):
        path = fresh_path(spark, "lines")
        scratch.paths.append(path)
        occurrences(documents).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
        everything = spark.read.schema(f"{OCCURRENCE}, batch int").parquet(path)
        runs, parts = LineRuns(spark, fanout), []
        try:
            for number in range(len(bounds) + 1):
                own = everything.where(F.col("batch") == number).drop("batch")
                run = runs.write(batch_state(own, runs))
                repeated = spark.table(run).where(F.col("known") | (F.col("first") < F.col("last")))
                decided = repeated.select(*KEYS, "known", "first", every_salt)
                lost = own.withColumn("salt", salt).join(decided, [*KEYS, "salt"])
                lost = lost.where(F.col("known") | (F.col("first") < F.col("doc_id")))
                part = lost.groupBy("doc_id", "body").agg(F.collect_set("line").alias("dropped"))
                parts.append(scratch.keep(part, "dropped-lines"))
                runs.settle(run)
        finally:
            runs.clear()
        dropped = parts[0]
        for part in parts[1:]:
            dropped = dropped.unionByName(part)
        return materialize(dropped, "dropped-lines")


def _marked(documents: DataFrame, batches: int, fanout: int) -> DataFrame:
    """Adds _n_lines, _n_dropped and _kept to documents whose columns a caller cannot have named like these."""
    dropped = dropped_lines(documents, batches, fanout).select(
        F.col("doc_id").alias("_id"), F.col("body").alias("_of"), F.col("dropped").alias("_dropped")
    )
    placed = documents.withColumn("_body", _body())
    joined = placed.join(dropped, (F.col("doc_id") == F.col("_id")) & (F.col("_body") == F.col("_of")), "left")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_dropped"))
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return joined.withColumns(
        {
            "_n_lines": F.size(lines).cast("bigint"),
            "_n_dropped": F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint"),
            "_kept": F.when(F.col("_dropped").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(text),
        }
    )


def mark_lines(documents: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """The caller's columns with n_lines, n_dropped and kept_text."""
    callers = Callers(documents, "doc_id", "text")
    return _marked(callers.df, batches, fanout).select(
        *callers.others("n_lines", "n_dropped", "kept_text"),
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.col("_kept").alias("kept_text"),
    )


def line_digests(documents: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the kept text."""
    digest = F.sha2(F.col("kept_text").cast("binary"), 256)
    marked = mark_lines(documents.select("doc_id", "text"), batches, fanout)
    return marked.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def without_repeated_lines(documents: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """The documents with their columns: texts without dropped lines, n_chars as it follows from them.

    A document all of whose lines are dropped goes; one that was empty before stays.
    """
    callers = Callers(documents, "doc_id", "text")
    marked = _marked(callers.df, batches, fanout)
    changed = F.col("_n_dropped") > 0
    new = {"text": F.when(changed, F.col("_kept")).otherwise(F.col("text"))}
    if "n_chars" in documents.columns:
        before = F.col(callers.names["n_chars"])
        new["n_chars"] = F.when(changed, F.length("_kept").cast(documents.schema["n_chars"].dataType)).otherwise(before)
    return marked.where(F.col("_n_dropped") < F.col("_n_lines")).select(*callers.columns(**new))
