"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each source gets a target number of words; words are allocated to sources by highest quotients (votes / 1, 3,
5, ...), then within a source to its shards in the same way, so every shard ends with an integer quota of words and
no source is too small for one. In a shard, documents stand in an order drawn by a seeded hash, and their words are
cut into equal blocks; the quota takes the shard as a whole as often as it can, and for the rest blocks at even
steps from a seeded start. Blocks have ``block_words`` words, or fewer where the rest would take less than
``LEAST_BLOCKS`` of them, so what is taken is within 1 / (2 * ``LEAST_BLOCKS``) of any quota. No word or
block is ever a row: how many words of a document lie in picked blocks follows from its first and last position.

Defined results: a null text has size 0; rows with a null source form one source of their own, last in
order; repeated rows are mixed as separate documents; a very long text is cut at blocks as any other; an empty table
gives an empty table. A caller's column named like a result column gives way to the result; names of other columns
are free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.text import SPACE, WORD, Callers
from beatgrid.session import Scratch, materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
BLOCK_WORDS = 64
LEAST_BLOCKS = 50
SHARD_WORDS = 1_000_000
SEED = 20_177


def _number(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _sized(documents: DataFrame, seed: int) -> DataFrame:
    """Adds _size, _source (never null), _order (seeded) and _body, which tells rows of one doc_id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    return documents.withColumns(
        {
            "_size": F.regexp_count(text, F.lit(WORD)).cast("bigint"),
            "_source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
            "_order": key,
            "_body": F.md5(text.cast("binary")),
        }
    )


def apportion(parties: DataFrame, group: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """Adds ``_seats``: each group's seats shared among its parties by the highest quotients votes / (2 j + 1).

    Rounding each exact share is right up to a few seats; only the seats next to that are compared, a number
    that stays in proportion to the number of parties. Ties go to the party that is first in order.
    """
    all_of = Window.partitionBy(*group)
    share = F.col(votes) / F.greatest(F.sum(votes).over(all_of), F.lit(1e-300))
    rounded = parties.withColumns({"_share": share, "_first": F.floor(share * F.col(seats) + 0.5)})
    gap = rounded.withColumns(
        {
            "_gap": (F.max(seats).over(all_of) - F.sum("_first").over(all_of)).cast("bigint"),
            "_n": F.count(F.lit(1)).over(all_of),
        }
    )
    reach = F.ceil(F.col("_share") * (F.abs("_gap") + F.col("_n"))) + 1
    first = F.when(F.col("_gap") > 0, F.col("_first")).otherwise(F.greatest(F.lit(0), F.col("_first") - reach))
    last = F.when(F.col("_gap") > 0, F.col("_first") + reach - 1).otherwise(F.col("_first") - 1)
    there = (F.col("_gap") != 0) & (first <= last) & (F.col(votes) > 0)
    seat = gap.where(there).select(*group, party, votes, "_gap", F.explode(F.sequence(first, last)).alias("_seat"))
    quotient = F.col(votes) / (2 * F.col("_seat") + 1)
    ranked = seat.withColumns(
        {
            "_high": F.row_number().over(all_of.orderBy(quotient.desc(), F.col(party))),
            "_low": F.row_number().over(all_of.orderBy(quotient.asc(), F.col(party).desc())),
        }
    )
    won = (F.col("_gap") > 0) & (F.col("_high") <= F.col("_gap"))
    lost = (F.col("_gap") < 0) & (F.col("_low") <= -F.col("_gap"))
    changes = (
        ranked.where(won | lost)
        .groupBy(*group, party)
        .agg(F.sum(F.when(won, 1).otherwise(-1)).alias("_change"))
    )
    total = F.col("_first") + F.coalesce("_change", F.lit(0))
    return (
        gap.join(changes, [*group, party], "left")
        .withColumn("_seats", F.greatest(F.lit(0), total).cast("bigint"))
        .drop("_share", "_first", "_gap", "_n", "_change")
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """(_source, source_size, target) from (_source, _size) rows.

    Targets are proportional to weights but stop at ``limit`` times the source's size; what is left over goes
    to the others by weight. A source is at its limit if filling all sources up to its level fits the total.
    """
    by_name = Window.orderBy(F.col("_source") == "", "_source")
    level = Window.orderBy("_level", "_source")
    to_here = level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(1))
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    sources = sizes.groupBy("_source").agg(F.sum("_size").alias("source_size")).withColumn("_weight", weight)
    room = (limit * F.col("source_size")).cast("double")
    filled = sources.withColumns({"_room": room, "_level": room / F.col("_weight")}).withColumns(
        {
            "_total": share * F.sum("source_size").over(everything),
            "_below": F.sum("_room").over(to_here),
            "_above": F.sum("_weight").over(everything) - F.sum("_weight").over(to_here),
        }
    )
    full = F.col("_below") + F.col("_level") * F.col("_above") <= F.col("_total")
    rest = F.col("_total") - F.sum(F.when(F.col("_full"), F.col("_room")).otherwise(0.0)).over(everything)
    weights_left = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_weight"))).over(everything)
    target = F.when(F.col("_full"), F.col("_room")).otherwise(F.col("_weight") * rest / weights_left)
    return filled.withColumn("_full", full).select("_source", "source_size", F.round(target, 6).alias("target"))


def _quotas(sizes: DataFrame, weights, share, limit, block_words, shard_words, seed, scratch: Scratch) -> DataFrame:
    """One row per shard: its size, its number of blocks, how often the mix takes all of it, and of how many blocks
    it takes one more.

    A quota above ``limit`` times the shard's size can only be the odd word that rounding gives to a source at its
    limit, all of whose shards are full, so nothing is to be handed on.
    """
    targets = scratch.keep(source_targets(sizes, weights, share, limit), "mix-targets")
    count = F.floor((F.col("source_size") + shard_words - 1) / shard_words)
    words = F.floor(F.sum("target").over(Window.partitionBy("_all")) + 0.5)
    sources = apportion(
        targets.withColumn("_all", F.lit(1)).withColumn("_seats_of_all", words),
        ["_all"],
        "_source",
        "target",
        "_seats_of_all",
    ).select("_source", "source_size", "target", "_seats", F.greatest(count, F.lit(1)).alias("_shards"))
    sources = scratch.keep(sources, "mix-sources")
    shards = (
        sizes.join(sources, "_source")
        .groupBy("_source", F.pmod(_number(F.col("_order")), F.col("_shards")).alias("_shard"))
        .agg(
            F.sum("_size").alias("_words"),
            *(F.first(name).alias(name) for name in ("source_size", "target", "_seats", "_shards")),
        )
        .withColumnRenamed("_seats", "_source_seats")
    )
    shared = apportion(scratch.keep(shards, "mix-shards"), ["_source"], "_shard", "_words", "_source_seats")
    quota, size = F.least(F.col("_seats"), limit * F.col("_words")), F.greatest(F.lit(1), F.col("_words"))
    block = F.least(F.lit(block_words), F.greatest(F.lit(1), F.floor((quota % size) / LEAST_BLOCKS)))
    pieces = F.greatest(F.lit(1), F.least(F.col("_words"), F.floor(F.col("_words") / block + 0.5)))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_source"), F.col("_shard").cast("string")).cast("binary"))
    rest = F.floor((quota % size) * F.col("_pieces") / size + 0.5)
    return shared.withColumn("_pieces", pieces.cast("bigint")).select(
        "_source",
        "_shard",
        "_shards",
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        "_words",
        "_pieces",
        F.floor(quota / size).alias("_full"),
        rest.cast("bigint").alias("_rest"),
        F.pmod(_number(key), F.col("_pieces")).alias("_start"),
    )


def _picked(pieces: Column) -> Column:
    """How many of a shard's first blocks are picked once more than the others."""
    return F.floor((pieces * F.col("_rest") + F.col("_start")) / F.col("_pieces"))


def _block(place: Column) -> Column:
    """The block that holds a position; the first blocks are one word longer than the rest."""
    size, longer = F.floor(F.col("_words") / F.col("_pieces")), F.col("_words") % F.col("_pieces")
    head = longer * (size + 1)
    after = longer + F.floor((place - head) / F.greatest(size, F.lit(1)))
    return F.when(place < head, F.floor(place / (size + 1))).otherwise(after)


def _taken_before(place: Column) -> Column:
    """Words in picked blocks among a shard's first words."""
    size, longer = F.floor(F.col("_words") / F.col("_pieces")), F.col("_words") % F.col("_pieces")
    block = _block(place)
    whole = _picked(block) * size + _picked(F.least(block, longer))
    inside = place - (block * size + F.least(block, longer))
    return whole + (_picked(block + 1) - _picked(block)) * inside


def _placed(documents: DataFrame, weights, share, limit, block_words, shard_words, seed) -> DataFrame:
    """Documents with their place in a shard (_from), how often the whole text is taken (_full), and how many of its
    words lie in blocks that are taken once more (_part). Only the columns used go through the shuffle by shard."""
    sized = _sized(documents, seed)
    with Scratch(documents.sparkSession) as scratch:
        sizes = scratch.keep(sized.select("_source", "_size", "_order"), "mix-sizes")
        quotas = _quotas(sizes, weights, share, limit, block_words, shard_words, seed, scratch)
        quotas = materialize(quotas, "mix-quotas")
    shard_counts = quotas.groupBy("_source").agg(F.first("_shards").alias("_shards"))
    placed = (
        sized.join(shard_counts, "_source")
        .withColumn("_shard", F.pmod(_number(F.col("_order")), F.col("_shards")))
        .drop("_shards")
        .join(quotas.drop("_shards"), ["_source", "_shard"])
    )
    order = Window.partitionBy("_source", "_shard").orderBy("_order", "_body")
    end = F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("_from", end - F.col("_size"))
    part = _taken_before(F.col("_from") + F.col("_size")) - _taken_before(F.col("_from"))
    return placed.withColumn("_part", part)


def mix(
    documents: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The caller's columns with size, source_size, target and taken (words the mix takes, repeats counted)."""
    callers = Callers(documents, "doc_id", "text", "source")
    placed = _placed(callers.df, weights, share, limit, block_words, shard_words, seed)
    return placed.select(
        *callers.others("size", "source_size", "target", "taken"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_full") * F.col("_size") + F.col("_part")).cast("bigint").alias("taken"),
    )


def mixed_texts(
    documents: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself, with the columns of ``documents``: a text taken twice comes twice, and one that lies only
    partly in picked blocks is cut to the words in them; n_chars follows the text."""
    callers = Callers(documents, "doc_id", "text", "source")
    placed = _placed(callers.df, weights, share, limit, block_words, shard_words, seed)
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"[{SPACE}]*{WORD}"), F.lit(0))

    def picked(_, index):
        block = _block(F.col("_from") + index)
        return _picked(block + 1) > _picked(block)

    cut = F.array_join(F.filter(pieces, picked), "")
    whole = F.array_repeat(F.col("text"), F.col("_full").cast("int"))
    part = F.when(F.col("_part") == F.col("_size"), F.col("text")).otherwise(cut)
    copies = F.concat(whole, F.when(F.col("_part") > 0, F.array(part)).otherwise(F.array().cast("array<string>")))
    texts = placed.withColumn("_text", F.explode(copies))
    return texts.select(*callers.columns(text=F.col("_text"), n_chars=F.length("_text").cast("bigint")))
