"""Model matrices: encoded training and test rows with the names of their features and classes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.operators.columns import NOT_IN_LABEL_ENCODED, NOT_IN_ONE_HOT, string_columns
from beatgrid.operators.encode import apply_codes, fit_codes, fit_vocabulary, one_hot
from beatgrid.session import materialize

# Label column, row key, and the prefixes of one-hot columns.
LABEL = "Category_New"
KEY = "PdId"
KEY_FEATURE = "PdId_feature"
PREFIXES = {"Season": "season", "PdDistrict": "pdDist", "DayOfWeek": "day"}

# A table is dealt to tasks by key, into a number that follows from its rows alone: tasks of SMALL_TASK rows up to the
# first number of a layout, then as many as its second number of rows each make. Every task of a forest's pass makes and
# sends the statistics of all open nodes, however few its rows are, so forests get few and large tasks.
# Where blocks of a forest are fitted a few at a time, its rows go to still fewer tasks beyond DEEP_ROWS rows: that many
# rows each, and DEEP_TASKS of them at least.
SMALL_TASK = 1_000
PASSES, FORESTS = (64, 200_000), (12, 400_000)
DEEP_ROWS, DEEP_TASKS = 100_000, 4


@dataclass(frozen=True)
class Matrices:
    """Rows keep their key and label; classes are the training labels in ascending order."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    classes: list[str]

    def stored(self, layout: tuple[int, int] = PASSES) -> Matrices:
        """The same rows as tables, for fits that pass over them many times; ``layout`` is that of the training rows."""
        train = _stored(self.train, "matrix-train", layout)
        return Matrices(train, _stored(self.test, "matrix-test"), self.features, self.classes)

    def for_blocks(self) -> Matrices:
        """Rows that are stored for forests, dealt anew for one whose blocks are fitted a few at a time."""
        rows, tasks = self.train.count(), self.train.rdd.getNumPartitions()
        fewer = max(DEEP_TASKS, -(-rows // DEEP_ROWS))
        if rows <= DEEP_ROWS or fewer >= tasks:
            return self
        return Matrices(self.train.repartition(fewer, KEY).sortWithinPartitions(KEY), self.test, self.features, self.classes)


def _stored(df: DataFrame, name: str, layout: tuple[int, int] = PASSES) -> DataFrame:
    """The rows as a table, dealt by key and sorted within tasks.

    Bagging draws by task, so a layout that depends on the rows only gives the same model on any cluster.
    """
    table = materialize(df, name)
    rows = table.count()
    most_small, large = layout
    tasks = max(1, min(most_small, -(-rows // SMALL_TASK)), -(-rows // large))
    return table.repartition(tasks, KEY).sortWithinPartitions(KEY)


def _matrices(train: DataFrame, test: DataFrame, dropped: tuple[str, ...], classes: list[str]) -> Matrices:
    """Matrices of encoded parts; dropped columns are no features, the key and the label go along."""
    features = [name for name in train.columns if name not in (*dropped, KEY)]
    extra = [] if KEY in dropped else [KEY_FEATURE]

    def rows(df: DataFrame) -> DataFrame:
        own = [F.col(f"`{name}`") for name in features]
        return df.select(KEY, LABEL, *own, *(F.col(KEY).alias(name) for name in extra))

    return Matrices(rows(train), rows(test), [*features, *extra], classes)


def label_encoded_matrices(
    train: DataFrame, test: DataFrame, dropped: tuple[str, ...] = NOT_IN_LABEL_ENCODED
) -> Matrices:
    """One-hot season, and codes of every other text column that stays; a value unseen in training gets the next
    free code. Features follow the order of the columns, the key, if it is one, comes last."""
    vocabulary = fit_vocabulary(train, LABEL, "Season")
    coded = [n for n in string_columns(train) if n not in (LABEL, "Season", *dropped)]
    fitted = fit_codes(train, *coded)

    def encode(df: DataFrame) -> DataFrame:
        codes = apply_codes(df, fitted, unseen=True)
        first = [F.col(n) for n in coded]
        others = [F.col(n) for n in df.columns if n not in coded]
        return one_hot(codes.select(*first, *others), {"Season": vocabulary["Season"]}, PREFIXES)

    return _matrices(encode(train), encode(test), dropped, vocabulary[LABEL])


def one_hot_matrices(train: DataFrame, test: DataFrame, dropped: tuple[str, ...] = NOT_IN_ONE_HOT) -> Matrices:
    """One-hot season, district and weekday."""
    vocabulary = fit_vocabulary(train, LABEL, *PREFIXES)
    hot = {name: vocabulary[name] for name in PREFIXES}
    return _matrices(one_hot(train, hot, PREFIXES), one_hot(test, hot, PREFIXES), dropped, vocabulary[LABEL])
