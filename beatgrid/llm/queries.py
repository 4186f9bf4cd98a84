"""One query per operator: (session, table folder) to DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from beatgrid.llm import (
    byte_bpe,
    exact_dedup,
    fingerprints,
    lexical_search,
    line_dedup,
    mixing,
    ngram_join,
    quality_classifier,
    repetition,
    substring_dedup,
    token_alignment,
    toxicity,
    url_filter,
)
from beatgrid.sources.parquet import read_table

#: The rank file of the byte-level vocabulary.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The two tokenizers that are aligned.
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register a query under the name of its function."""
    QUERIES[function.__name__] = function
    return function


@query
def op1_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition(read_table(spark, folder, "documents"))


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, folder, "pages"))


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_edited(read_table(spark, folder, "documents"))


@query
def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked(read_table(spark, folder, "documents"))


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digests(read_table(spark, folder, "documents"))


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score_quality(
        read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    )


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, folder, "documents"), RANKS)


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeat_digests(read_table(spark, folder, "documents"))


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.statistics(read_table(spark, folder, "documents"), BYTE_LEVEL, PIECES)


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.owners(read_table(spark, folder, "documents"))
