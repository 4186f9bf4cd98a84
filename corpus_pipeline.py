"""The corpus pipeline: each stage's result is written and reread as the next one's documents.

A document that the toxicity chain rejects goes; repeated lines go, and documents that had nothing else; one
document of each group of near duplicates stays; sources are mixed to their target weights, so a text may come
twice or in part; what is left is encoded. SQL cannot express the first and the last stage.

Defined results: a null or empty text is clean, has no lines to repeat and no near duplicate; mixing takes it as
often as it takes its shard as a whole. A null doc_id is never learned from nor compared, and its row stays up to mixing. Rows
of one doc_id are one document for lines and near duplicates, and documents of their own for mixing. Equal texts are
settled by the smallest doc_id, ties in mixing by a hash of text. Very long texts go through whole. Columns beyond
those of documents, of any name, are carried along; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.llm import byte_bpe, line_dedup, mixing, ngram_join, toxicity
from beatgrid.llm.batches import small_batches, small_groups
from beatgrid.session import Scratch, materialize, remove
from beatgrid.sources.parquet import read_table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Near duplicates: Jaccard similarity of five-word shingles of 0.8 or more. 85 and 4 bind only op4's query.
NEAR_PERCENT, NEAR_WORDS = 80, 5


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, percent=NEAR_PERCENT, length=NEAR_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_texts(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns but the text, with ids, offsets and number of tokens, as a table."""
    with small_batches(spark), small_groups(spark):
        encoded = byte_bpe.encode(docs, RANKS)
        return materialize(encoded.withColumn("n_tokens", F.size("ids").cast("bigint")), "byte_bpe")


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_each),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents of a folder of tables; the tables in between are removed."""
    docs = read_table(spark, sf_dir, "documents")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.keep(stage(spark, docs, sf_dir), name)
            for path in scratch.paths[:-1]:
                remove(spark, path)
            scratch.paths = scratch.paths[-1:]
        _, stage = STAGES[-1]  # which writes its own table
        return stage(spark, docs, sf_dir)
