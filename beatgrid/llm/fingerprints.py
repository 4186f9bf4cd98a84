"""Document fingerprints: bottom-k sketches of the hashes of five-word shingles.

A sketch is the k smallest distinct shingle hashes, ascending. Sketches of parts merge into the sketch of the
whole, and two sketches give estimates of resemblance, containment and the number of distinct shingles; below
k shingles all of these are exact. Everything is a column expression.

To compare a text with its edited form, whose end comes from the next document, documents are put in order by
a range partitioning of (doc_id, hash of the text) alone; then each text moves once to its own place and a
quarter of it, with its sketch, to the place of the document before it.

Defined results: a null text counts as empty; an empty text has an empty sketch, likeness 1 to another empty
text and 0 to any other; a text of fewer than five words is one shingle; rows that agree in doc_id and text
are one document in the order and get equal results; a null doc_id comes first; in a table of one document
the next document is itself; an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.text import words
from beatgrid.session import materialize

SHINGLE_WORDS = 5
SIZE = 256
FIRST = -(2**63)


def word_hashes(text: Column) -> Column:
    """A hash of every word in order; compute it as a column of its own before :func:`sketch_of`."""
    return F.transform(words(text), lambda word: F.xxhash64(word))


def sketch_of(hashes: Column, size: int = SIZE, shingle: int = SHINGLE_WORDS) -> Column:
    """The sketch of a text from the column that holds its word hashes."""

    def gram(index: Column) -> Column:
        return F.xxhash64(*(F.get(hashes, index + k) for k in range(shingle)))

    n = F.size(hashes)
    shingles = (
        F.when(n >= shingle, F.transform(F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))), gram))
        .when(n > 0, F.array(F.xxhash64(hashes)))
        .otherwise(F.array().cast("array<bigint>"))
    )
    return bottom(shingles, size)


def bottom(hashes: Column, size: int = SIZE) -> Column:
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, size)


def merge(left: Column, right: Column, size: int = SIZE) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.array_sort(F.array_union(left, right)), 1, size)


def merge_groups(sketches: DataFrame, sketch: str, *keys: str, size: int = SIZE) -> DataFrame:
    """One sketch per group of rows: the smallest distinct hashes, of which no more than ``size`` are gathered."""
    hashes = sketches.select(*keys, F.explode(sketch).alias("_h")).distinct()
    ranked = hashes.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h")))
    return ranked.where(F.col("_r") <= size).groupBy(*keys).agg(F.array_sort(F.collect_list("_h")).alias(sketch))


def resemblance(left: Column, right: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both hold."""
    both = merge(left, right, size)
    common = F.size(F.array_intersect(F.array_intersect(both, left), right))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))


def distinct_count(sketch: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    largest = (F.element_at(sketch, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < size, F.size(sketch).cast("double")).otherwise((size - 1) / largest)


def containment(part: Column, whole: Column, size: int = SIZE) -> Column:
    """Estimated share of the first text's shingles that the second holds; 1 for a text without shingles."""
    union = distinct_count(merge(part, whole, size), size)
    share = resemblance(part, whole, size) * union / distinct_count(part, size)
    return F.when(F.size(part) == 0, 1.0).otherwise(F.least(F.lit(1.0), share))


def as_text(sketch: Column) -> Column:
    """The hashes as hexadecimal digits, 16 each."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _order(keyed: DataFrame) -> DataFrame:
    """For each (_id, _body): the document before it and how many characters that one takes from it."""
    own = keyed.groupBy("_id", "_body").agg(F.max("_n").alias("_n"))
    spread = own.repartitionByRange("_id", "_body").withColumn("_part", F.spark_partition_id())
    placed = materialize(spread, "document-order")
    firsts = placed.groupBy("_part").agg(
        F.min(F.struct("_id", "_body")).alias("_start"), F.max(F.struct("_id", "_body", "_n")).alias("_end")
    )
    row = Window.partitionBy(F.lit(1)).orderBy("_part")  # one row per partition
    before = F.coalesce(
        F.lag("_end").over(row),
        F.last("_end").over(row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    ends = firsts.select("_part", before.alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_id", "_body")
    joined = placed.join(ends, "_part")
    previous = F.coalesce(F.lag(F.struct("_id", "_body", "_n")).over(inside), F.col("_before"))
    linked = joined.select("_id", "_body", previous.alias("_p"))
    return linked.select(
        "_id",
        "_body",
        F.col("_p._id").alias("_p_id"),
        F.col("_p._body").alias("_p_body"),
        F.floor(F.col("_p._n") / 4).cast("int").alias("_need"),
    )


def compare_with_edited(documents: DataFrame, size: int = SIZE, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness to it and to the next document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = documents.select("doc_id", text.alias("_text")).withColumns(
        {"_id": F.coalesce("doc_id", F.lit(FIRST)), "_body": F.xxhash64("_text"), "_n": F.length("_text")}
    )
    same = Window.partitionBy("_id", "_body")
    placed = (
        keyed.join(_order(keyed), ["_id", "_body"])
        .withColumn("_copy", F.row_number().over(same.orderBy("doc_id")))
        .withColumn("_hashes", word_hashes(F.col("_text")))
        .withColumn("_sketch", sketch_of(F.col("_hashes"), size, shingle))
    )
    given = placed.where(F.col("_copy") == 1).select(
        F.col("_p_id").alias("_id"),
        F.col("_p_body").alias("_body"),
        # The length is named so that both uses of the texts in their places read one and the same shuffle.
        F.expr("substring(_text, 1, least(_need, _n))").alias("_tail"),
        F.col("_sketch").alias("_next"),
    )
    head = F.expr("substring(_text, 1, cast(_n - floor(_n / 4) as int))")
    own = placed.select("doc_id", "_id", "_body", "_n", "_text", "_sketch")
    edited = (
        own.join(given, ["_id", "_body"])
        .withColumn("_edited", F.concat(head, F.col("_tail")))
        .withColumn("_edited_hashes", word_hashes(F.col("_edited")))
        .withColumn("_edited_sketch", sketch_of(F.col("_edited_hashes"), size, shingle))
    )
    return edited.select(
        "doc_id",
        F.col("_n").cast("bigint").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_sketch")).alias("fingerprint"),
        as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        F.round(resemblance(F.col("_sketch"), F.col("_edited_sketch"), size), 9).alias("near_edited"),
        F.round(resemblance(F.col("_sketch"), F.col("_next"), size), 9).alias("near_next"),
        F.round(distinct_count(F.col("_sketch"), size), 3).alias("n_shingles"),
        F.round(containment(F.col("_sketch"), F.col("_edited_sketch"), size), 9).alias("contained_in_edited"),
    )
