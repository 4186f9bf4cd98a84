"""URL filter: rules first, then the likelihood ratio of two character models.

URLs that a rule decides are the training set: one variable-order Markov model for accepted and one for
rejected URLs. Each predicts a character from up to ``LONGEST`` before it. The estimate of a context is blended
with that of the next shorter one, which weighs more the rarer the context is, and a context never seen leaves
the estimate of the longest one seen. A URL's score is the difference of the two log-likelihoods per character,
and the threshold is the score that best separates the accepted from the rejected URLs of a fold held out from
training.

The model is a table of (context and character, counts), as large as what the URLs hold: it grows with them, and is
shuffled and joined by the context and character. Each length is joined with the next shorter one, where a key
has at most as many rows as there are characters. Counts are combined before the shuffle, over all URLs, and each
distinct URL is taken apart and scored once.

Characters are read as they are. A start of URLs that many hosts share is one key of the join with the model, whose
rows adaptive execution splits; the model's side has one row for it.

Defined results: a URL that is null or has no ``://`` has an empty host and path, no rule, and is allowed if
the score of no characters, 0, is; without training URLs of both kinds every undecided URL is allowed;
repeated rows get equal results; a very long URL has as many contexts as characters; an empty table gives an empty
table; other columns, of any name, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatgrid.llm.text import ascii_lower
from beatgrid.session import Scratch, materialize

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Stands before the first character.
START = "\x00"
#: Characters before each one.
LONGEST = 5
STRENGTH = 4.0
#: Log ratios are kept as whole numbers of this fraction.
UNIT = 1_000_000_000
#: Every score is counted in steps of this size, within the bounds, to find the threshold.
STEP, BOUND = 0.01, 5.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, F.lit("://")), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict), both null where no rule fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def characters(url: Column) -> Column:
    """The characters after ``://``."""
    at = F.coalesce(F.instr(url, F.lit("://")), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def with_grams(urls: DataFrame, order: int) -> DataFrame:
    """A row per character of ``own``: ``gram``, the ``order`` characters before it and its own."""
    padded = urls.withColumn("_padded", F.concat(F.lit(START * order), "own"))
    last = F.length("own")
    places = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1))))
    grams = F.transform(places, lambda i: F.substring("_padded", i, F.lit(order + 1)))
    return padded.select(*urls.columns, F.explode(grams).alias("gram"))


def log_ratios(grams: DataFrame, order: int, symbols: int) -> DataFrame:
    """(gram, ratio): ln of accepted over rejected probability, in units, for every gram; from (gram, allow, block),
    the counts in accepted and rejected URLs, 0 where a gram is only in others; ``symbols`` is the number of
    characters among which one of which nothing is known is drawn."""
    model = None
    for width in range(1, order + 2):
        tail = F.substring(F.col("gram"), order + 2 - width, width)
        level = grams.groupBy(tail.alias("gram")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        level = level.withColumn("_context", F.substring(F.col("gram"), 1, width - 1))
        # The empty context's rows are as many as there are characters, a longer one's at most that.
        totals = level.groupBy("_context").agg(F.sum("allow").alias("t_allow"), F.sum("block").alias("t_block"))
        level = level.join(totals, "_context")
        if model is None:
            level = level.withColumns({"b_allow": F.lit(1 / symbols), "b_block": F.lit(1 / symbols)})
        else:
            shorter = model.select(
                F.col("gram").alias("_shorter"), F.col("p_allow").alias("b_allow"), F.col("p_block").alias("b_block")
            )
            level = level.withColumn("_shorter", F.substring(F.col("gram"), 2, width - 1)).join(shorter, "_shorter")
        model = level.select(
            "gram",
            *(
                ((F.col(k) + STRENGTH * F.col(f"b_{k}")) / (F.col(f"t_{k}") + STRENGTH)).alias(f"p_{k}")
                for k in ("allow", "block")
            ),
        )
    ratio = F.round(F.log(F.col("p_allow") / F.col("p_block")) * UNIT)
    return model.select("gram", ratio.cast("bigint").alias("ratio"))


def scores(urls: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """(url, score) of the URLs that have characters, from (id, url, own); whole units are summed, so the order of
    rows does not matter. Both sides are shuffled by gram, ids in place of URLs."""
    joined = with_grams(urls.select("id", "own"), order).select("id", "gram").join(model, "gram")
    score = F.round(F.sum("ratio") / UNIT / F.count(F.lit(1)), 9)
    return joined.groupBy("id").agg(score.alias("score")).join(urls.select("id", "url"), "id").select("url", "score")


def threshold(scored: DataFrame) -> DataFrame:
    """One row with ``threshold``: the score with the largest sum of both classes' hit rates; 0 where one class is
    missing. From (label, score); counted in steps, so the result has a fixed number of candidates."""
    steps = int(BOUND / STEP)
    step = F.greatest(F.lit(-steps), F.least(F.lit(steps), F.floor(F.col("score") / STEP)))
    bins = scored.groupBy(step.alias("step")).agg(
        F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("b")
    )
    below = Window.partitionBy(F.lit(1)).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    hits = bins.select(
        "step",
        (1 - F.coalesce(F.sum("a").over(below), F.lit(0)) / F.sum("a").over(everything)).alias("kept"),
        (F.coalesce(F.sum("b").over(below), F.lit(0)) / F.sum("b").over(everything)).alias("stopped"),
    )
    order = F.struct(F.round(F.col("kept") + F.col("stopped"), 9), -F.abs("step"), F.col("step"))
    best = hits.where(F.col("kept").isNotNull() & F.col("stopped").isNotNull()).agg(F.max_by("step", order).alias("s"))
    return best.select((F.coalesce("s", F.lit(0)) * STEP).alias("threshold"))


def filter_urls(pages: DataFrame, rules=RULES, order: int = LONGEST) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page."""
    host, path = host_and_path(F.col("url"))
    rule, decided = longest_rule(F.col("host"), F.col("path"), rules)
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumns(
        {"rule": rule, "label": decided}
    )
    held_out = F.substring(F.md5(F.col("url").cast("binary")), 1, 1).isin("0", "1", "2")
    labelled = parsed.where(F.col("label").isNotNull())
    with Scratch(pages.sparkSession) as scratch:
        # A URL's rows all have its label; those that teach count as often as they stand in the table.
        urls = parsed.where(F.col("url").isNotNull()).groupBy("url", "label").agg(F.count(F.lit(1)).alias("n"))
        urls = urls.select(
            F.monotonically_increasing_id().alias("id"),
            "url",
            characters(F.col("url")).alias("own"),
            *(F.when((F.col("label") == k) & ~held_out, F.col("n")).otherwise(0).alias(k) for k in ("allow", "block")),
        )
        urls = scratch.keep(urls, "url-list")  # ids are kept with it
        grams = with_grams(urls.select("own", "allow", "block"), order).groupBy("gram")
        grams = grams.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        grams = scratch.keep(grams, "url-grams")
        own = F.substring(F.col("gram"), order + 1, 1)
        taught = grams.where("allow + block > 0").select(own.alias("own"))
        model = scratch.keep(log_ratios(grams, order, taught.distinct().count() + 1), "url-model")
        scored = materialize(scores(urls, model, order), "url-scores")
    limit = materialize(threshold(labelled.where(held_out).join(scored, "url")), "url-threshold")
    score = F.coalesce("score", F.lit(0.0))
    own = F.when(score >= limit.scalar(), "allow").otherwise("block")
    return parsed.join(scored, "url", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("label", own).alias("verdict"), score.alias("score")
    )
