"""N-gram Jaccard join: blocked sparse products of document by shingle incidence, within size-derived bounds.

Rows of the incidence matrix are distinct shingle sets, so exact copies are one row however many there are.
All sets order their shingles in the same way: shingles that many documents hold last, else by hash. Two
sets can reach the similarity only if they share a shingle among their first n - ceil(t n) + 1 (a prefix), if
their sizes are near enough, and if what remains behind the shared shingle is long enough; other pairs are
discarded by these bounds before any product. Overlap is accumulated over the prefixes first, and only pairs
that can still reach the similarity are multiplied in full.

A shingle's holders are a block. First the document in which it comes earliest, that with the fewest shingles of
its own, is multiplied with all others; links found give components. Only in blocks whose holders are not all in one component by then, the holders outside the
largest one are multiplied with the holders they are not yet joined to. So a group of many near copies costs
products in proportion to its size, and no link between different components is lost. A document that meets many
others is copied to several parts, so its pairs lie in no single task.

The list of frequent shingles only changes the order; it is cut at ``COMMON_SHINGLES`` entries by raising the
count it starts from, and that is the bound of what is broadcast. Any list gives the same result.

Defined results: a null or empty text has an empty set, size 0, and is linked with nothing, as is a null doc_id,
whose component is null; rows of one doc_id are one document, linked by what any of them is linked with; an
empty table gives an empty table. Other columns are not read, and pass through :func:`one_of_each`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.batches import small_batches
from beatgrid.llm.hashing import joined_words, run_hashes, signed, word_hashes
from beatgrid.session import Scratch, materialize

SHINGLE_WORDS = 4
PERCENT = 85
COMMON_SHINGLES = 1_000_000
COMMON_COUNT = 16
SALTS = 32
#: Documents per part in which shingles are counted.
PART_DOCUMENTS = 2_000


def shingle_set(text: str | None, length: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending."""
    data, begins, ends = joined_words((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(begins):
        return np.zeros(0, dtype=np.int64)
    words = word_hashes(data, begins, ends)
    if len(words) < length:  # the whole sequence; the word in front keeps lengths apart
        words = np.concatenate(([np.uint64(len(words))], words))
        return run_hashes(words, len(words)).view(np.int64)
    return np.unique(run_hashes(words, length).view(np.int64))


class Common:
    """Shingles that stand in many documents, by the leading bits of their hashes."""

    def __init__(self, codes: np.ndarray, shift: int) -> None:
        self.codes, self.shift = codes, np.uint64(shift)

    def last(self, shingles: np.ndarray) -> np.ndarray:
        """Ascending shingles in the order all sets share: common ones last."""
        if not len(self.codes) or not len(shingles):
            return shingles
        codes = shingles.view(np.uint64) >> self.shift
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        common = self.codes[place] == codes
        return np.concatenate((shingles[~common], shingles[common]))


def common_shingles(documents: DataFrame, length: int, scratch: Scratch, most: int | None = None) -> Common:
    """Shingles that at least COMMON_COUNT documents hold; at most ``most``.

    All shingles of all texts are counted. A task combines the equal ones of many texts, parts the distinct ones
    by leading bits of the hash and sends one packed row per part, 32 further bits and a count for each; there
    are as many parts as keep each small.
    """
    most = COMMON_SHINGLES if most is None else most
    bits = max(6, math.ceil(math.log2(max(1, documents.count()) / PART_DOCUMENTS + 1)))
    shift = 64 - bits - 32

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def parts() -> pd.DataFrame:
            codes, counts = np.unique(np.concatenate(held).view(np.uint64) >> np.uint64(shift), return_counts=True)
            part = (codes >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            ends = [*cuts[1:].tolist(), len(codes)]
            rest, counts = codes.astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
            return pd.DataFrame(
                {
                    "part": part[cuts],
                    "codes": [rest[a:b].tobytes() for a, b in zip(cuts, ends)],
                    "counts": [counts[a:b].tobytes() for a, b in zip(cuts, ends)],
                }
            )

        for batch in batches:
            for text in batch["text"]:
                held.append(shingle_set(text, length))
                size += len(held[-1])
                if size > 4_000_000:
                    yield parts()
                    held, size = [], 0
        if size:
            yield parts()

    def counted(part: pd.DataFrame) -> pd.DataFrame:
        codes = np.frombuffer(b"".join(part["codes"]), dtype=np.uint32)
        counts = np.frombuffer(b"".join(part["counts"]), dtype=np.uint8).astype(np.int64)
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        total = np.add.reduceat(counts[order], first)
        many = total >= COMMON_COUNT
        code = (part["part"].iloc[0] << 32) + codes[first][many].astype(np.int64)
        return pd.DataFrame({"code": code, "n": total[many]})

    rows = documents.select("text").mapInPandas(packed, "part bigint, codes binary, counts binary")
    counts = scratch.keep(rows.groupBy("part").applyInPandas(counted, "code bigint, n bigint"), "common-shingles")
    classes = counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("c")).collect()
    total, least = 0, None
    for row in sorted(classes, reverse=True):
        total += row["c"]
        if total > most:
            break
        least = 2 ** row["power"]
    if least is None:
        return Common(np.zeros(0, dtype=np.uint64), shift)
    found = counts.where(F.col("n") >= least).select("code").toPandas()["code"]
    return Common(np.sort(found.to_numpy(dtype=np.int64).view(np.uint64)), shift)


def _prefixes(documents: DataFrame, percent: int, length: int, common: Common) -> DataFrame:
    """(doc_id, n, s1, s2, prefix): size of each set, its 128-bit name, and its first shingles."""
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = shingle_set(text, length)
                n = len(own)
                first = shared.value.last(own)[: n - -(-percent * n // 100) + 1] if n else own
                rows.append((doc_id, n, *signed(own.tobytes(), 16), first))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "s1", "s2", "prefix"])

    schema = "doc_id bigint, n int, s1 bigint, s2 bigint, prefix array<bigint>"
    return documents.select("doc_id", "text").mapInPandas(prefixes, schema)


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _rest_fits(a: Column, at_a: Column, b: Column, at_b: Column, percent: int) -> Column:
    """Whether what stands from the shared shingle on can reach the overlap that the sizes ask for."""
    return F.least(a - at_a, b - at_b) * (100 + percent) >= (a + b) * percent


def _met(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (a, b) with the columns of both. A document with many partners is copied to those of ``SALTS`` parts
    that hold a partner, so no task gets all its pairs, and one with few is copied to few."""
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).alias("_salt"))
    copies = salted.select("a", "_salt").distinct().join(left, "a")
    return salted.join(right, "b").join(copies, ["a", "_salt"]).drop("_salt")


def _promising(pairs: DataFrame, ones: DataFrame, percent: int) -> DataFrame:
    """Pairs whose overlap within the prefixes leaves them a chance.

    What two sets share beyond it lies behind the prefix that ends first, so it is at most the rest of one set."""
    left, right = (ones.select(F.col("doc_id").alias(k), F.struct("n", "prefix").alias(f"_{k}")) for k in ("a", "b"))
    both = _met(pairs, left, right)
    a, b = F.col("_a"), F.col("_b")
    overlap = F.size(F.array_intersect(a["prefix"], b["prefix"]))
    rest = F.greatest(a["n"] - F.size(a["prefix"]), b["n"] - F.size(b["prefix"]))
    return both.where((overlap + rest) * (100 + percent) >= (a["n"] + b["n"]) * percent).select("a", "b").distinct()


def _products(pairs: DataFrame, documents: DataFrame, length: int, percent: int) -> DataFrame:
    """(a, b) of the pairs that reach the similarity: sparse products by blocks of rows with one left side.

    Only texts of documents in a pair are turned into rows of the matrix."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = _sets(documents.join(named, "doc_id"), length)

    def multiplied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = [], []
            for a, rows in batch.groupby("a", sort=False):
                own = np.sort(np.asarray(rows["set_a"].iloc[0], dtype=np.int64))
                others = rows["set_b"].tolist()
                same = rows["key_a"].tolist()
                if len(set(same)) > 1:  # rows of one doc_id with different texts
                    parts = [(np.sort(np.asarray(s, dtype=np.int64)), [o]) for s, o in zip(rows["set_a"], others)]
                else:
                    parts = [(own, others)]
                overlaps, sizes_a, sizes_b = [], [], []
                for mine, theirs in parts:
                    sizes = np.array([len(o) for o in theirs])
                    entries = np.concatenate(theirs)
                    place = np.minimum(np.searchsorted(mine, entries), len(mine) - 1)
                    starts = np.cumsum(sizes) - sizes
                    overlaps.append(np.add.reduceat((mine[place] == entries).astype(np.int64), starts))
                    sizes_b.append(sizes)
                    sizes_a.append(np.full(len(sizes), len(mine)))
                overlap, n_a, n_b = map(np.concatenate, (overlaps, sizes_a, sizes_b))
                linked = 100 * overlap >= percent * (n_a + n_b - overlap)
                right += rows["b"].to_numpy()[linked].tolist()
                left += [a] * int(linked.sum())
            yield pd.DataFrame({"a": left, "b": right}, dtype="int64")

    left = sets.select(F.col("doc_id").alias("a"), F.col("s1").alias("key_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    joined = _met(pairs, left, right)
    return joined.select("a", "b", "key_a", "set_a", "set_b").mapInPandas(multiplied, "a bigint, b bigint").distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): every node of the links with the smallest node it is connected with.

    Each round every node joins its smallest neighbour and the links are drawn between those; the links left
    shrink by a factor, so the number of rounds follows the logarithm of the longest path.
    """
    links = scratch.keep(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v"), "links")
    steps: list[DataFrame] = []
    while not links.isEmpty():
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joins = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("to"))
        joins = scratch.keep(joins, "component-step")
        steps.append(joins)
        moved = links.join(joins, "u").select("v", F.col("to").alias("a"))
        moved = moved.join(joins.select(F.col("u").alias("v"), "to"), "v").select(F.col("a").alias("u"), F.col("to").alias("v"))
        links = scratch.keep(moved.where("u <> v").distinct(), "links")
    if not steps:
        return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    labels = steps[0].select(F.col("u").alias("node"), F.col("to").alias("component"))
    for step in steps[1:]:
        following = step.select(F.col("u").alias("component"), "to")
        labels = labels.join(following, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return scratch.keep(labels, "components")


def linked(documents: DataFrame, percent: int = PERCENT, length: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    documents = documents.select("doc_id", "text")
    with Scratch(documents.sparkSession) as scratch, small_batches(documents.sparkSession):
        return materialize(_linked(documents, percent, length, scratch), "components")


def _linked(documents: DataFrame, percent: int, length: int, scratch: Scratch) -> DataFrame:
    common = common_shingles(documents, length, scratch)
    rows = scratch.keep(_prefixes(documents, percent, length, common), "shingle-prefixes")
    full = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = full.groupBy("s1", "s2").agg(F.min("doc_id").alias("one"))
    classes = scratch.keep(classes, "shingle-classes")
    ones = full.join(classes.select("s1", "s2", F.col("one").alias("doc_id")), ["s1", "s2", "doc_id"])
    ones = scratch.keep(ones, "shingle-rows")
    entries = ones.select("doc_id", "n", F.posexplode("prefix").alias("at", "t"))
    shared = entries.groupBy("t").agg(F.count(F.lit(1)).cast("int").alias("c")).where(F.col("c") > 1)
    blocks = scratch.keep(entries.join(shared, "t"), "shingle-blocks")

    first = blocks.groupBy("t").agg(F.min(F.struct("at", "doc_id", "n")).alias("first"))
    start = F.col("first")
    pairs = blocks.join(first, "t").where(
        (start["doc_id"] != F.col("doc_id"))
        & _sizes_fit(start["n"], F.col("n"), percent)
        & _rest_fits(start["n"], start["at"], F.col("n"), F.col("at"), percent)
    )
    ends = (start["doc_id"], F.col("doc_id"))
    pairs = pairs.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
    pairs = scratch.keep(pairs, "first-pairs")
    chosen = scratch.keep(_promising(pairs, ones, percent), "promising-pairs")
    links = _products(chosen, documents, length, percent)
    # Rows of one doc_id with several texts: its smallest class is linked with every other one.
    named = full.join(classes, ["s1", "s2"]).select("doc_id", "one")
    several = named.groupBy("doc_id").agg(F.min("one").alias("a"), F.max("one").alias("_last"))
    several = several.where("a <> _last").select("doc_id", "a")
    star = named.distinct().join(several, "doc_id").where("one <> a").select("a", F.col("one").alias("b"))
    links = scratch.keep(links.unionByName(star.distinct()), "first-links")
    labels = components(links, scratch)

    # In a block of two there is no pair left; in larger ones the first document is done.
    member = blocks.where(F.col("c") > 2).join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    member = member.select("t", "doc_id", "n", "at", F.coalesce("component", "doc_id").alias("component"))
    sizes = member.groupBy("t", "component").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("t").agg(
        F.max_by("component", F.struct("c", "component")).alias("main"), F.count(F.lit(1)).alias("k")
    )
    member = scratch.keep(member.join(main.where(F.col("k") > 1).drop("k"), "t"), "open-blocks")
    outside = member.where(F.col("component") != F.col("main")).alias("o")
    other = member.alias("m")
    unlike = (F.col("o.t") == F.col("m.t")) & (F.col("o.component") != F.col("m.component"))
    once = (F.col("m.component") == F.col("m.main")) | (F.col("o.doc_id") < F.col("m.doc_id"))
    bounds = _sizes_fit(F.col("o.n"), F.col("m.n"), percent) & _rest_fits(
        F.col("o.n"), F.col("o.at"), F.col("m.n"), F.col("m.at"), percent
    )
    more = outside.join(other, unlike & once & bounds).select(
        F.least("o.doc_id", "m.doc_id").alias("a"), F.greatest("o.doc_id", "m.doc_id").alias("b")
    )
    more = scratch.keep(more.distinct().join(pairs, ["a", "b"], "left_anti"), "second-pairs")
    chosen = scratch.keep(_promising(more, ones, percent), "promising-pairs")
    more_links = _products(chosen, documents, length, percent)
    final = components(links.unionByName(more_links), scratch)

    named = rows.drop("prefix").join(classes, ["s1", "s2"], "left")
    named = named.join(final.withColumnRenamed("node", "one"), "one", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "one")).otherwise(F.col("doc_id"))
    return named.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
    )


def _sets(texts: DataFrame, length: int) -> DataFrame:
    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, length) for t in batch["text"]]
            names = [signed(s.tobytes(), 16)[0] for s in sets]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "s1": names, "shingles": sets})

    found = texts.select("doc_id", "text").mapInPandas(whole, "doc_id bigint, s1 bigint, shingles array<bigint>")
    return found.where(F.size("shingles") > 0)


def one_of_each(documents: DataFrame, percent: int = PERCENT, length: int = SHINGLE_WORDS) -> DataFrame:
    """The document with the smallest doc_id of each component, with its columns; unlinked documents all stay.

    Of rows that agree in doc_id all stay or go together."""
    dropped = linked(documents, percent, length).where(F.col("component_id") != F.col("doc_id"))
    return documents.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(
        *(f"`{name}`" for name in documents.columns)
    )
