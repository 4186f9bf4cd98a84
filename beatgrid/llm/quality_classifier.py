"""Quality classifier: ridge scores on random Fourier features, calibrated by isotonic regression.

Each text becomes a few statistics; standardised, they pass through random cosines whose inner products
approximate a Gaussian kernel. Every task sums its rows' part of the normal equations, the parts are added by
grouping, and the one small system is solved where the program runs. The scores of rows left out of the fit
are counted in bins and made monotone by pooling adjacent violators, which turns a score into a probability.

Learning uses rows with a label and crc32(doc_id as text) mod 5 of 1 to 4: 1 calibrates, 2 to 4 fit. Labels,
lang, source and doc_id never enter a score. All labelled rows are used; what reaches the driver is bounded by
the number of features and bins.

Defined results: a null text counts as empty, and an empty text is scored from statistics that are all zero; a
null doc_id is never held out nor learned from; a null label is no label; without rows to fit, every score is
0.5, without rows to calibrate the clipped ridge score; repeated rows get equal results and, labelled, count
each; an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.session import materialize

STATISTICS = 22
FEATURES = 256
WIDTH = 4.0
RIDGE = 1e-4
SEED = 20_231
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
BINS = 2_000
LOW, HIGH = -0.5, 1.5
THRESHOLD = 0.3

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_CAPITALS, _DIGITS, _SIGNS, _STOPS = (np.zeros(256, dtype=bool) for _ in range(4))
_CAPITALS[65:91] = True
_DIGITS[48:58] = True
_SIGNS[list(b"#*$%&|<>@^~_={}[]\\+")] = True
_STOPS[list(b".,;:!?")] = True


def statistics(text: str | None) -> np.ndarray:
    """What the model sees of a text: sizes, shares of kinds of characters, repetition."""
    out = np.zeros(STATISTICS)
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n, size = len(words), len(data)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    often = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [line for line in data.split(b"\n") if line.strip()]
    share = counts / size
    used = share[counts > 0]
    last = Counter(word[-1] for word in words)
    out[:] = (
        np.log1p(n),
        np.log1p(size),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        share[_LETTERS].sum(),
        share[_CAPITALS].sum(),
        share[_DIGITS].sum(),
        share[_SIGNS].sum(),
        share[_STOPS].sum(),
        share[33],
        share[10],
        len(often) / n,
        max(often.values()) / n,
        len(pairs) / max(n - 1, 1),
        max(pairs.values(), default=0) / n,
        len(set(lines)) / len(lines),
        np.log1p(size / len(lines)),
        sum(c for sign, c in last.items() if not _LETTERS[sign]) / n,
        sum(c for word, c in often.items() if len(word) == 1) / n,
        -(used * np.log(used)).sum(),
        sum(c for word, c in often.items() if word.isupper()) / n,
    )
    return out


def text_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every text, in one map over the scan."""

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [statistics(t) for t in batch["text"]]})

    return documents.select("doc_id", "text").mapInPandas(measured, "doc_id bigint, x array<double>")


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.vstack(batch["x"].to_numpy()) if len(batch) else np.zeros((0, STATISTICS))


class Model:
    """Standardisation, random features, ridge weights and calibration; a few thousand numbers."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, seed: int = SEED) -> None:
        draw = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.directions = draw.normal(0.0, 1.0 / WIDTH, (STATISTICS, features))
        self.phases = draw.uniform(0.0, 2 * np.pi, features)
        self.weights: np.ndarray | None = None
        self.steps: tuple[np.ndarray, np.ndarray] | None = None

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8) @ self.directions + self.phases
        return np.hstack((np.sqrt(2 / len(self.phases)) * np.cos(z), np.ones((len(x), 1))))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        calibrated = np.interp(raw, *self.steps) if self.steps else np.clip(raw, 0, 1)
        return np.round(calibrated, 6)


def pool_adjacent(places: np.ndarray, weights: np.ndarray, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: (centre of each block, its mean), both ascending."""
    blocks: list[list[float]] = []
    for place, weight, mean in zip(places, weights, means):
        blocks.append([place * weight, weight, mean * weight])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(examples: DataFrame) -> Model:
    """The model from (x, label, fold) rows."""
    rows = examples.where((F.col("fold") != CALIBRATION) & (F.col("fold") != HELD_OUT))
    moments = {
        r["pos"]: (r["m"], r["s"])
        for r in rows.select(F.posexplode("x").alias("pos", "v"))
        .groupBy("pos")
        .agg(F.round(F.avg("v"), 9).alias("m"), F.round(F.stddev_pop("v"), 9).alias("s"))
        .collect()
    }
    mean, spread = (np.array([moments.get(i, (0.0, 1.0))[k] for i in range(STATISTICS)]) for k in (0, 1))
    model = Model(mean, spread)
    if not moments:
        return model
    size = FEATURES + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 2))
        for batch in batches:
            z = model.expand(_matrix(batch))
            total[:, :size] += z.T @ z
            total[:, size] += z.T @ batch["label"].to_numpy(dtype=float)
            total[:, size + 1] += len(batch)
        yield pd.DataFrame({"i": np.arange(size), "v": list(total)})

    parts = rows.select("x", "label").mapInPandas(sums, "i int, v array<double>")
    added = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    table = added.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("row")).collect()
    system = np.zeros((size, size + 2))
    for row in table:
        system[row["i"]] = [cell["v"] for cell in row["row"]]
    count = system[0, size + 1]
    penalty = np.eye(size) * RIDGE * count
    penalty[-1, -1] = 1e-9 * count
    model.weights = np.linalg.solve(system[:, :size] + penalty, system[:, size])

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = (np.clip(model.raw(_matrix(batch)), LOW, HIGH) - LOW) / (HIGH - LOW) * BINS
            yield pd.DataFrame({"bin": np.round(place).astype(int), "label": batch["label"]})

    left = examples.where(F.col("fold") == CALIBRATION).select("x", "label")
    bins = left.mapInPandas(binned, "bin int, label double").groupBy("bin")
    counted = sorted(bins.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("y")).collect())
    if counted:
        place, n, y = (np.array(c, dtype=float) for c in zip(*counted))
        model.steps = pool_adjacent(place / BINS * (HIGH - LOW) + LOW, n, y / n)
    return model


def fold_of(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    measured = materialize(text_statistics(documents), "text-statistics")
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    marked = marked.select("doc_id", F.col("quality").cast("double").alias("label"))
    examples = measured.join(marked, "doc_id").select("x", "label", fold_of().alias("fold"))
    model = fit(materialize(examples.where(F.col("fold") != HELD_OUT), "quality-examples"))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.score(_matrix(batch))})

    scores = measured.mapInPandas(scored, "doc_id bigint, score double")
    return scores.select(
        "doc_id",
        F.coalesce(fold_of() == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
