"""Substring dedup by super-k-mer partitioning: every window of 50 words, exactly.

A window's minimiser is the smallest hash of the 10-word runs inside it. Consecutive windows that share it form
a super-k-mer, a run of words that a hash of its bytes and its minimiser describe. Only minimisers that two
documents hold matter further. Where all super-k-mers of a minimiser are equal, their first document decides
for all their windows. Where they differ, one occurrence of each distinct string travels, packed, to the
bucket of its minimiser, where its windows are sorted and each window's smallest doc_id is found; equal
windows have equal minimisers, so no bucket needs another. Word counts of a window are exact up to 128-bit
hashes of its bytes.

What is repeated is combined before it moves: minimisers to first and last document, equal strings to their
first occurrence. Texts move once, to learn whether anything in them is held elsewhere; those without go no
further, the others are stored and meet their repeated spans later.

Defined results: windows are compared between doc_ids, so rows of one doc_id never remove each other's words;
a null doc_id neither removes nor loses words; a null text has no words, and neither has an empty one; texts
under 50 words lose nothing; a very long text is one run of words as any other; an empty table gives an empty table.
Other columns, of any name, are not read by the digests and pass through :func:`without_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.hashing import joined_words, run_hashes, signed, word_hashes
from beatgrid.llm.text import Callers, words
from beatgrid.session import materialize

WINDOW_WORDS = 50
RUN_WORDS = 10
KEY = ["doc_id", "body"]
SUPER = "m bigint, ph bigint, doc_id bigint, body bigint, start int, n int"
PACKED = "m bigint, ph bigint, first bigint, packed binary"
WINDOWS = "m bigint, ph bigint, first bigint, place int, w1 bigint, w2 bigint"


def super_kmers(data: bytes, begins: np.ndarray, ends: np.ndarray, window: int = WINDOW_WORDS) -> list[tuple]:
    """(minimiser, first word, number of windows) of each run of windows that share a minimiser."""
    n = len(begins)
    if n < window:
        return []
    run = min(RUN_WORDS, window)
    runs = run_hashes(word_hashes(data, begins, ends), run)
    width, least = window - run + 1, runs
    reach = 1  # a minimum over 2^k runs from two over half as many
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(runs) - width + 1], least[width - reach :])
    cuts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]))
    return list(zip(least[cuts[:-1]].view(np.int64).tolist(), cuts[:-1].tolist(), np.diff(cuts).tolist()))


def _super_rows(documents: DataFrame, window: int) -> DataFrame:
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["m", "ph", "doc_id", "body", "start", "n"]
        for batch in batches:
            rows = []
            for doc_id, body, text in zip(batch["doc_id"].tolist(), batch["body"].tolist(), batch["text"]):
                data, begins, ends = joined_words(text.encode("utf-8", "surrogatepass"))
                for m, start, n in super_kmers(data, begins, ends, window):
                    packed = data[begins[start] : ends[start + n + window - 2]]
                    rows.append((m, *signed(packed), doc_id, body, start, n))
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    named = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return named.select("doc_id", _body().alias("body"), "text").mapInPandas(found, SUPER)


def _body() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _packed(stored: DataFrame, window: int) -> DataFrame:
    """The strings asked for, cut from their texts."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, asked in zip(batch["doc_id"].tolist(), batch["text"], batch["asked"]):
                data, begins, ends = joined_words(text.encode("utf-8", "surrogatepass"))
                for one in asked:
                    start, n = one["start"], one["n"]
                    rows.append((one["m"], one["ph"], doc_id, data[begins[start] : ends[start + n + window - 2]]))
                if len(rows) > 10_000:
                    yield pd.DataFrame(rows, columns=["m", "ph", "first", "packed"])
                    rows = []
            yield pd.DataFrame(rows, columns=["m", "ph", "first", "packed"])

    asked = stored.where(F.col("asked").isNotNull()).select("doc_id", "text", "asked")
    return asked.mapInPandas(cut, PACKED)


def _windows(bucketed: DataFrame, window: int) -> DataFrame:
    """A row per window of every packed string, in its bucket."""

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["m", "ph", "first", "place", "w1", "w2"]
        for batch in batches:
            rows = []
            for m, ph, first, packed in zip(*(batch[c].tolist() for c in ("m", "ph", "first", "packed"))):
                parts = packed.split(b" ")
                begins = np.cumsum([0, *(len(p) + 1 for p in parts)]).tolist()
                for place in range(len(parts) - window + 1):
                    piece = packed[begins[place] : begins[place + window] - 1]
                    rows.append((m, ph, first, place, *signed(piece, 16)))
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return bucketed.mapInPandas(opened, WINDOWS)


def _repeats(documents: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(stored, spans). stored: every row with its text where it holds a super-k-mer found elsewhere, else with its
    digest; spans: per document the windows whose words stand in a smaller doc_id."""
    found = materialize(_super_rows(documents, window), "super-kmers")
    held = found.groupBy("m").agg(
        F.min("doc_id").alias("first"),
        F.max("doc_id").alias("last"),
        (F.min("ph") != F.max("ph")).alias("mixed"),
    )
    live = found.join(held.where(F.col("first") < F.col("last")).drop("last"), "m")
    live = materialize(live, "live-super-kmers")
    distinct = live.where("mixed").groupBy("m", "ph").agg(F.min(F.struct(*KEY, "start", "n")).alias("one"))
    asked = distinct.groupBy(F.col("one.doc_id").alias("doc_id"), F.col("one.body").alias("body")).agg(
        F.collect_list(F.struct("m", "ph", "one.start", "one.n")).alias("asked")
    )
    holders = live.select(*KEY).distinct().join(asked, KEY, "left").withColumn("_live", F.lit(True))
    own = words(F.col("text"))
    rows = documents.select("doc_id", "text", _body().alias("body")).join(holders, KEY, "left")
    stored = rows.select(
        *KEY,
        "asked",
        F.when(F.col("_live"), F.col("text")).alias("text"),
        F.when(F.col("_live").isNull(), F.size(own)).alias("n_words"),
        F.when(F.col("_live").isNull(), F.sha2(F.array_join(own, " ").cast("binary"), 256)).alias("sha"),
    )
    stored = materialize(stored, "texts-with-repeats")
    buckets = _windows(_packed(stored, window).repartition("m"), window)
    equal = Window.partitionBy("m", "w1", "w2")
    least = buckets.withColumn("least", F.min("first").over(equal))
    strings = least.groupBy("m", "ph").agg(F.array_sort(F.collect_list(F.struct("place", "least"))).alias("_least"))
    known = live.join(materialize(strings, "bucket-results"), ["m", "ph"], "left")
    among = F.filter(F.col("_least"), lambda w: w["least"] < F.col("doc_id"))
    every = F.when(F.col("first") < F.col("doc_id"), F.sequence(F.lit(0), F.col("n") - 1))
    places = F.when(F.col("mixed"), F.transform(among, lambda w: w["place"])).otherwise(every)
    spans = known.select(*KEY, "start", places.alias("places")).where(F.size("places") > 0)
    spans = spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "places")).alias("spans"))
    return stored, spans


def _covered(n: int, spans, window: int) -> np.ndarray:
    """Which of n words any of the windows covers."""
    covered = np.zeros(n + 1, dtype=np.int64)
    for span in spans if spans is not None else ():
        at = np.asarray(span["places"], dtype=np.int64) + span["start"]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + window, -1)
    return np.cumsum(covered[:n]) > 0


def repeat_digests(documents: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the words that stay, joined by one space."""
    stored, spans = _repeats(documents.select("doc_id", "text"), window)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch["doc_id"].tolist(), batch["text"], batch["spans"]):
                parts = text.encode("utf-8", "surrogatepass").split()
                gone = _covered(len(parts), found, window)
                kept = b" ".join(part for part, out in zip(parts, gone) if not out)
                rows.append((doc_id, len(parts), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=columns)

    open_rows = stored.where(F.col("text").isNotNull()).join(spans, KEY, "left").select("doc_id", "text", "spans")
    changed = open_rows.mapInPandas(digests, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    done = stored.where(F.col("text").isNull()).select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.col("sha").alias("kept_sha256"),
    )
    return done.unionByName(changed)


def without_repeats(documents: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The documents with their columns; texts that lost words are the remaining words joined by one space."""
    callers = Callers(documents, "doc_id", "text")
    _, spans = _repeats(callers.df.select("doc_id", "text"), window)
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("body").alias("_of"), F.col("spans").alias("_spans"))

    @F.pandas_udf("string")
    def remaining(texts: pd.Series, found: pd.Series) -> pd.Series:
        kept = []
        for text, spans_ in zip(texts, found):
            parts = text.split(" ") if spans_ is not None else []
            gone = _covered(len(parts), spans_, window)
            kept.append(" ".join(p for p, out in zip(parts, gone) if not out) if spans_ is not None else text)
        return pd.Series(kept)

    placed = callers.df.withColumn("_body", _body())
    joined = placed.join(spans, (F.col("doc_id") == F.col("_id")) & (F.col("_body") == F.col("_of")), "left")
    normal = F.array_join(words(F.col("text")), " ")
    text = F.when(F.col("_spans").isNotNull(), remaining(normal, F.col("_spans"))).otherwise(F.col("text"))
    return joined.select(*callers.columns(text=text))
