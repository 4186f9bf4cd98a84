"""Toxicity by a classifier chain: categories in order, each linear model sees the earlier probabilities.

Features are words (lower-case runs of letters) present in a text, chosen from the training texts by the
likelihood-ratio test of their counts in positive and other ones. The first category is fitted on the words alone; each later one
gets the earlier categories' probabilities as further inputs. In training these come from models that did not see
the row (out-of-fold), when scoring from the model fitted on all rows. The last category decides: its
threshold is the one with the best F-score among out-of-fold predictions, precision weighing twice as much.

Training takes at most ``TRAIN_ROWS`` labelled doc_ids, those with the smallest hashes, and one row of each, the one
whose text has the smallest hash; this is the documented bound of the sample. The model reads every word that passes
the test. Scoring covers all rows and whole texts; it is one map over the scan.

The tables label only ``toxic``; two finer categories are derived for the chain from where marked words stand, which
the words' presence does not tell: ``repeated`` (toxic, and one of them comes twice) and ``clustered`` (toxic, and two
of them stand within ``CLUSTER`` words). The chain itself takes any label columns in any order.

Defined results: a null or empty text has no words and gets the probabilities of none; a very long text is one set of
words as any other; a null doc_id is scored but never learned from; null labels are left out; without labelled rows
of both kinds every probability is 0 and nothing is rejected; repeated rows get equal results; an empty table gives an
empty table. Other columns of any name pass through :func:`without_toxic` and are not read otherwise.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.batches import small_batches
from beatgrid.llm.text import Callers
from beatgrid.session import Scratch

TRAIN_ROWS = 20_000
LEAST_DOCUMENTS = 5
#: Least likelihood-ratio statistic of a word's counts against the overall share of positive texts.
LEAST_GAIN = 18.0
MARKED_RATIO = 20.0
#: Words that a task counts before it hands them on.
WORDS_HELD = 30_000
CLUSTER = 5
FOLDS = 4
PENALTY = 0.1
ROUNDS = 400

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _sample(labels: DataFrame, rows: int) -> DataFrame:
    order = F.xxhash64("doc_id")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    return known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(order, "doc_id").limit(rows)


def vocabulary(examples: DataFrame) -> list[tuple[str, float]]:
    """(word, ratio) of the words whose counts tell positive examples from others, from (text, toxic) rows."""

    def rows(yes: Counter, every: Counter) -> pd.DataFrame:
        words = list(every)
        found = {"word": words, "yes": [yes[w] for w in words], "no": [every[w] - yes[w] for w in words]}
        return pd.DataFrame(found).astype({"word": str, "yes": "int64", "no": "int64"})

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yes, every = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                own = set(words_of(text))
                every.update(own)
                if toxic > 0:
                    yes.update(own)
                if len(every) > WORDS_HELD:
                    yield rows(yes, every)
                    yes, every = Counter(), Counter()
        yield rows(yes, every)

    found = examples.select("text", "toxic").mapInPandas(counted, "word string, yes bigint, no bigint")
    counts = found.groupBy("word").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    counts = counts.where(F.col("yes") + F.col("no") >= LEAST_DOCUMENTS)
    totals = examples.agg(
        F.greatest(F.count_if(F.col("toxic") > 0), F.lit(1)).alias("yes"),
        F.greatest(F.count_if(F.col("toxic") <= 0), F.lit(1)).alias("no"),
    ).first()
    ratio = ((F.col("yes") + 0.5) / totals["yes"]) / ((F.col("no") + 0.5) / totals["no"])
    share = totals["yes"] / (totals["yes"] + totals["no"])
    together = F.col("yes") + F.col("no")

    def part(count: F.Column, expected: F.Column) -> F.Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    gain = 2 * (part(F.col("yes"), together * share) + part(F.col("no"), together * (1 - share)))
    best = counts.select("word", ratio.alias("ratio"), gain.alias("gain")).where(F.col("gain") >= LEAST_GAIN)
    return [(r["word"], r["ratio"]) for r in best.orderBy(F.desc("gain"), "word").collect()]


class Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[list[int]], width: int) -> None:
        self.counts = np.array([len(r) for r in rows], dtype=np.int64)
        self.columns = np.array([c for r in rows for c in r], dtype=np.int64)
        self.owner = np.repeat(np.arange(len(rows)), self.counts)
        self.width = width

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.columns], minlength=len(self.counts))

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, values[self.owner], minlength=self.width)


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _fit_linear(rows: Rows, extra: np.ndarray, label: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Logistic regression with an L2 penalty by accelerated gradient steps; weights of words, inputs, intercept."""
    n = use.sum()
    dense = np.hstack((extra, np.ones((len(label), 1))))
    width = rows.width
    lipschitz = 0.25 * (rows.counts.max(initial=0) + (dense**2).sum(axis=1).max(initial=1)) + PENALTY / max(n, 1)
    weights = np.zeros(width + dense.shape[1])
    ahead, pace = weights.copy(), 1.0
    for _ in range(ROUNDS):
        odds = rows.times(ahead[:width]) + dense @ ahead[width:]
        error = np.where(use, _probability(odds) - label, 0.0) / max(n, 1)
        slope = np.concatenate((rows.transposed_times(error), dense.T @ error))
        slope[:-1] += PENALTY / max(n, 1) * ahead[:-1]
        new = ahead - slope / lipschitz
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / next_pace * (new - weights)
        weights, pace = new, next_pace
    return weights


class Chain:
    """The fitted models in order, with the words they read."""

    def __init__(self, words: list[str], categories: list[str]) -> None:
        self.place = {word: i for i, word in enumerate(words)}
        self.categories = categories
        self.models: list[np.ndarray] = []
        self.threshold = 2.0

    def fit(self, rows: list[list[int]], labels: dict[str, np.ndarray], folds: np.ndarray) -> Chain:
        sparse = Rows(rows, len(self.place))
        earlier = np.zeros((len(rows), 0))
        everywhere = np.ones(len(rows), dtype=bool)
        for name in self.categories:
            label = labels[name].astype(float)
            width = sparse.width
            unseen = np.zeros(len(rows))
            for fold in range(FOLDS):
                part = _fit_linear(sparse, earlier, label, folds != fold)
                odds = sparse.times(part[:width]) + earlier @ part[width:-1] + part[-1]
                unseen[folds == fold] = odds[folds == fold]
            self.models.append(_fit_linear(sparse, earlier, label, everywhere))
            earlier = np.column_stack((earlier, _probability(unseen)))
        self.threshold = _best_threshold(_probability(unseen), labels[self.categories[-1]])
        return self

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities of each text by category."""
        if not self.models:
            return np.zeros((len(texts), len(self.categories)))
        known = self.place.keys()
        rows = Rows([sorted(self.place[w] for w in known & set(words_of(t))) for t in texts], len(known))
        earlier = np.zeros((len(texts), 0))
        out = []
        for model in self.models:
            odds = rows.times(model[: rows.width]) + earlier @ model[rows.width : -1] + model[-1]
            out.append(_probability(odds))
            earlier = np.column_stack((earlier, _probability(odds)))
        return np.column_stack(out)


def _best_threshold(probability: np.ndarray, label: np.ndarray) -> float:
    order = np.argsort(-probability, kind="stable")
    hits = np.cumsum(label[order])
    score = 1.25 * hits / (np.arange(1, len(order) + 1) + 0.25 * max(label.sum(), 1))
    at = int(np.argmax(score))
    following = probability[order[at + 1]] if at + 1 < len(order) else 0.0
    return float((probability[order[at]] + following) / 2)


def _examples(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """One row (doc_id, toxic, text) of each sampled doc_id, however many rows it has."""
    sample = F.broadcast(_sample(labels, rows))  # at most ``rows`` pairs of numbers
    chosen = documents.select("doc_id", "text").join(sample, "doc_id")
    return chosen.groupBy("doc_id").agg(
        F.max("toxic").cast("double").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")
    )


def standing(places: list[int | None], marked: set[int]) -> tuple[bool, bool]:
    """Whether a marked word comes twice, and whether two stand within CLUSTER words."""
    at = [i for i, place in enumerate(places) if place in marked]
    twice = len({places[i] for i in at}) < len(at)
    return twice, any(b - a <= CLUSTER for a, b in zip(at, at[1:]))


def fit_chain(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Chain:
    """The chain repeated, clustered, toxic from labels.toxic."""
    with Scratch(documents.sparkSession) as scratch, small_batches(documents.sparkSession):
        examples = scratch.keep(_examples(documents, labels, rows), "toxicity-examples")
        words = vocabulary(examples)
        chain = Chain([word for word, _ in words], ["repeated", "clustered", "toxic"])
        place = chain.place
        marked = {place[word] for word, ratio in words if ratio >= MARKED_RATIO}

        def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                places = [[place.get(w) for w in words_of(text)] for text in batch["text"]]
                result = pd.DataFrame([standing(row, marked) for row in places], columns=["twice", "near"], dtype=bool)
                result["found"] = [sorted({p for p in row if p is not None}) for row in places]
                yield result.assign(doc_id=batch["doc_id"].to_numpy(), toxic=batch["toxic"].to_numpy())

        table = examples.mapInPandas(numbered, "doc_id bigint, toxic double, found array<int>, twice boolean, near boolean")
        fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS))
        local = table.withColumn("fold", fold).orderBy("doc_id").collect()
    toxic, twice, near = (np.array([bool(r[name]) for r in local], dtype=bool) for name in ("toxic", "twice", "near"))
    if not toxic.any() or toxic.all():
        return chain
    derived = {"repeated": toxic & twice, "clustered": toxic & near, "toxic": toxic}
    return chain.fit([list(r["found"]) for r in local], derived, np.array([r["fold"] for r in local]))


def _probabilities(chain: Chain) -> F.Column:
    """An array of probabilities, through one vectorised function over the text."""

    @F.pandas_udf("array<double>")
    def probabilities(texts: pd.Series) -> pd.Series:
        return pd.Series(list(np.round(chain.predict(texts.tolist()), 6)))

    return probabilities(F.col("text"))


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, a probability per category, and whether the document is rejected."""
    chain = fit_chain(documents, labels)
    scored = documents.select("doc_id", _probabilities(chain).alias("p"))
    shares = [F.get("p", F.lit(i)).alias(f"p_{name}") for i, name in enumerate(chain.categories)]
    return scored.select("doc_id", *shares).withColumn("rejected", F.col("p_toxic") >= chain.threshold)


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    chain = fit_chain(documents, labels)
    callers = Callers(documents, "text")
    scored = callers.df.withColumn("_p", _probabilities(chain))
    return scored.where(F.get("_p", F.lit(len(chain.categories) - 1)) < chain.threshold).select(*callers.columns())
