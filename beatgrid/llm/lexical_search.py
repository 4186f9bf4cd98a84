"""Ranked lexical search: exact top documents of many items by norm buckets of impact vectors.

A document's score for an item is an inner product: the item's vector has one coordinate per term, the document's its
impacts. Both are scaled by the root of the term's weight. As in LEMP, the vectors are ordered by length and cut into
buckets of similar length. For an item and a bucket, the product of the item's length with the largest of the bucket
bounds every score there (Cauchy-Schwarz): below the item's tenth score so far, the bucket is left out. Inside a
bucket, the rarest terms (half of the item's weight) are added up by coordinate; what the other terms can add is at
most the smaller of two bounds, the item's rest times the root of what is left of the document's squared length, and the
sum of the largest coordinates in the bucket. Documents that can still reach the tenth score are scored in 64-bit
integers. First bounds come from the first bucket of up to ``SEEDS`` parts; they only spare work and any bound gives
the same result.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, so what the tasks get is bounded however many items there
are; documents are read once per block and reduced to the block's terms. No row is sent per pair of item and
document: each task keeps ten documents per item, and those are ranked after the map side has dropped all beyond ten.
Equal vectors are parted by their place, so copies of one text fill no single task.

Defined results: a null or empty text has no terms; such a document is in no result and not in the counts, such an
item has no rows. Rows of one item_id count as one item with the terms of all of them (null is an id of its own).
Repeated documents are ranked each by itself; equal scores go by ascending doc_id, a null doc_id last. A very long
text is read in windows. Extra columns are not read. Without documents or without items the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.batches import small_batches
from beatgrid.llm.text import CAPITALS, SMALL, ascii_lower
from beatgrid.session import Scratch, materialize

TOP = 10
#: Distinct terms of items, summed over items, in one block.
BLOCK_TERMS = 200_000
#: Vectors in a bucket.
BUCKET = 2_048
#: Parts of the ordered vectors whose first bucket gives the first bounds.
SEEDS = 64
#: Bytes of a text whose terms are listed at once, and of texts gathered for one batch.
WINDOW_BYTES = 4_000_000
#: ASCII characters that part terms.
PARTING = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_ID = (1 << 63) - 1

_LETTERS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_FOLDED = _LETTERS.translate(bytes.maketrans(CAPITALS.encode(), SMALL.encode()))
VECTORS = "place bigint, doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
ORDERED = "place bigint, doc_id bigint, length double, m bigint, terms array<int>, tfs array<bigint>"
FOUND = "item int, doc_id bigint, score bigint"


def term_list(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in windows that end between terms."""
    folded, at = data.translate(_FOLDED), 0
    while at < len(folded):
        end = folded.find(b" ", at + WINDOW_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _vectors(documents: DataFrame, vocabulary) -> DataFrame:
    """Per document with a term: place, doc_id, its number of terms, and the block's terms in it with occurrences."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, place = vocabulary.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, 1_000):
                part = batch.slice(start, 1_000)
                kept, counts, found = [], [], []
                for row, data in enumerate(part.column("text").to_pylist()):
                    n = 0
                    for terms in term_list(data or b""):
                        n += len(terms)
                        own = np.fromiter((i for i in map(number.get, terms) if i is not None), dtype=np.int64)
                        if len(own):
                            found.append(own + (len(kept) << 32))
                    if n:
                        kept.append(row)
                        counts.append(n)
                keys, tfs = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
                ends = pa.array(np.searchsorted(keys, np.arange(len(kept) + 1) << 32), pa.int32())
                columns = [
                    pa.array(np.arange(place, place + len(kept))),
                    part.column("doc_id").take(pa.array(kept, pa.int64())),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array((keys & 0xFFFFFFFF).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tfs.astype(np.int64))),
                ]
                place += len(kept)
                yield pa.RecordBatch.from_arrays(columns, names=["place", "doc_id", "n", "terms", "tfs"])

    columns = F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")
    return documents.select(*columns).mapInArrow(vectors, VECTORS)


def impacts(tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tfs) // (1_000 * tfs + 8 * m)


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, occurrences, and the row of each."""
    terms, tfs = batch.column("terms"), batch.column("tfs")
    sizes = np.diff(terms.offsets.to_numpy())
    return terms.flatten().to_numpy(), tfs.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)


def _with_length(vectors: DataFrame, weights, n_documents: int, n_terms: int) -> DataFrame:
    """The vectors with m and the length of the scaled impact vector."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value.astype(np.float64)
        for batch in batches:
            m = 100 - 90 + (90 * batch.column("n").to_numpy() * n_documents) // n_terms
            terms, tfs, row = _lists(batch)
            squares = weight[terms] * impacts(tfs, m[row]).astype(np.float64) ** 2
            length = np.sqrt(np.bincount(row, squares, minlength=len(m)))
            columns = [batch.column("place"), batch.column("doc_id"), pa.array(length), pa.array(m)]
            columns += [batch.column("terms"), batch.column("tfs")]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "doc_id", "length", "m", "terms", "tfs"])

    return vectors.mapInArrow(measured, ORDERED)


class Item:
    """An item's terms by falling weight; the first ``focus`` of them hold half of the weight."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray) -> None:
        own = weights[terms]
        order = np.lexsort((terms, -own))
        self.terms, self.weights = terms[order], own[order]
        total = np.cumsum(self.weights)
        self.length = math.sqrt(total[-1]) if len(total) else 0.0
        self.focus = int(np.searchsorted(total, total[-1] / 2)) + 1 if len(total) else 0
        self.rest = math.sqrt(float(self.weights[self.focus :].sum()))


class Bucket:
    """Vectors of similar length, with postings by term."""

    def __init__(self, batch: pa.RecordBatch, n_vocabulary: int) -> None:
        terms, tfs, row = _lists(batch)
        order = np.argsort(terms, kind="stable")
        self.impact = impacts(tfs, batch.column("m").to_numpy()[row])[order]
        self.row, terms = row[order], terms[order]
        self.begins = np.searchsorted(terms, np.arange(n_vocabulary + 1))
        self.lengths = batch.column("length").to_numpy()
        self.longest = self.lengths.max()
        ids = batch.column("doc_id").fill_null(NO_ID)
        self.ids, self.size = ids.to_numpy(), len(self.lengths)
        self.most = np.zeros(n_vocabulary, np.int64)
        used = np.flatnonzero(np.diff(self.begins))
        if len(used):
            self.most[used] = np.maximum.reduceat(self.impact, self.begins[used])

    def postings(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, impact and weight of each posting of some terms."""
        begins, sizes = self.begins[terms], self.begins[terms + 1] - self.begins[terms]
        at = np.arange(sizes.sum()) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
        return self.row[at], self.impact[at], np.repeat(weights, sizes)

    def reach(self, item: Item, least: int) -> np.ndarray:
        """Rows that may score ``least`` or more; none if the bucket as a whole cannot."""
        if _below(item.length * self.longest, least):
            return np.zeros(0, np.int64)
        row, impact, weight = self.postings(item.terms[: item.focus], item.weights[: item.focus])
        sums = np.bincount(row, weight * impact, minlength=self.size)
        squares = np.bincount(row, weight * impact.astype(np.float64) ** 2, minlength=self.size)
        rest = item.rest * np.sqrt(np.maximum(self.lengths**2 * (1 + 1e-9) - squares, 0))
        most = float((item.weights[item.focus :] * self.most[item.terms[item.focus :]]).sum())
        return np.flatnonzero(~_below(sums + np.minimum(rest, most), least))

    def scores(self, item: Item, rows: np.ndarray) -> np.ndarray:
        """Exact scores of some rows."""
        row, impact, weight = self.postings(item.terms, item.weights)
        nth = np.full(self.size, -1, np.int64)
        nth[rows] = np.arange(len(rows))
        wanted = nth[row] >= 0
        out = np.zeros(len(rows), np.int64)
        np.add.at(out, nth[row[wanted]], weight[wanted] * impact[wanted])
        return out


def _below(bound, least: int):
    """Whether a bound, with room for rounding, is below a score."""
    return bound * (1 + 1e-9) + 1 < least


class Best:
    """The best documents of one item so far."""

    def __init__(self, least: int, top: int) -> None:
        self.least, self.top = max(1, least), top
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        enough = scores >= self.least
        scores, ids = np.concatenate((self.scores, scores[enough])), np.concatenate((self.ids, ids[enough]))
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.top:
            self.least = int(self.scores[-1])


def _search(ordered: DataFrame, query, top: int, first_only: bool, bucket: int) -> DataFrame:
    """Each task's best documents per item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items, bounds = query.value
        items = [Item(terms, weights) for terms in items]
        best = [Best(least, top) for least in bounds]
        for batch in batches:
            for start in range(0, batch.num_rows, bucket):
                own = Bucket(batch.slice(start, bucket), len(weights))
                for item, found in zip(items, best):
                    rows = own.reach(item, found.least)
                    if len(rows):
                        found.add(own.scores(item, rows), own.ids[rows])
                if first_only:
                    break
            if first_only:
                break
        numbers = np.repeat(np.arange(len(best)), [len(found.ids) for found in best]).astype(np.int32)
        ids = np.concatenate([np.zeros(0, np.int64), *(found.ids for found in best)])
        scores = np.concatenate([np.zeros(0, np.int64), *(found.scores for found in best)])
        ids = pa.array(ids, pa.int64(), mask=ids == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(numbers), ids, pa.array(scores)], names=["item", "doc_id", "score"])

    return ordered.select("doc_id", "length", "m", "terms", "tfs").mapInArrow(search, FOUND)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(documents: DataFrame, block: list, scratch: Scratch, top: int, bucket: int) -> DataFrame:
    """item (number in ``block``, a list of lists of terms), rank, doc_id, score."""
    context = documents.sparkSession.sparkContext
    words = sorted({term for terms in block for term in terms})
    number = {word.encode("utf-8", "surrogatepass"): i for i, word in enumerate(words)}
    vectors = scratch.keep(_vectors(documents, context.broadcast(number)), "term-vectors")
    n_documents, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
    frequency = np.zeros(len(words), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the block's terms
        frequency[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)
    measured = _with_length(vectors, context.broadcast(weights), n_documents, n_terms or 1)
    ordered = measured.repartitionByRange(F.desc("length"), F.asc("place")).sortWithinPartitions(F.desc("length"))
    ordered = scratch.keep(ordered.withColumn("part", F.spark_partition_id()), "ordered-vectors")
    items = [np.array([number[t.encode("utf-8", "surrogatepass")] for t in terms], np.int64) for terms in block]
    items = [terms[frequency[terms] > 0] for terms in items]
    parts = (ordered.agg(F.max("part")).first()[0] or 0) + 1
    seeds = ordered.where(F.col("part") % max(1, -(-parts // SEEDS)) == 0)
    query = context.broadcast((weights, items, [0] * len(items)))
    first = _ranked(_search(seeds, query, top, True, bucket), top).where(F.col("rank") == top)
    bounds = [0] * len(items)
    for row in first.select("item", "score").collect():  # a row per item of the block at most
        bounds[row["item"]] = row["score"]
    query = context.broadcast((weights, items, bounds))
    return scratch.keep(_ranked(_search(ordered, query, top, False, bucket), top), "block-ranks")


def search(
    documents: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, bucket: int = BUCKET
) -> DataFrame:
    """The best ``top`` documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score."""
    spark = documents.sparkSession
    terms = F.filter(F.split(ascii_lower(F.col("text")), PARTING), lambda term: term != "")
    with Scratch(spark) as scratch, small_batches(spark):
        pairs = scratch.keep(items.select("item_id", F.explode(terms).alias("term")).distinct(), "item-terms")
        blocks = -(-pairs.count() // block_terms)
        results = []
        for block in range(blocks):
            mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
            by_id: dict = {}
            for item_id, term in mine.collect():  # about block_terms rows
                by_id.setdefault(item_id, []).append(term)
            ids = sorted(by_id, key=lambda i: (i is None, str(i)))
            if not ids:
                continue
            found = _search_block(documents, [by_id[i] for i in ids], scratch, top, bucket)
            schema = f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
            names = spark.createDataFrame(list(enumerate(ids)), schema)
            results.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        if not results:
            empty = items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"))
            return empty.withColumn("score", F.lit(0).cast("bigint")).where(F.lit(False))
        result = results[0]
        for more in results[1:]:
            result = result.unionByName(more)
        return materialize(result, "lexical-search")
