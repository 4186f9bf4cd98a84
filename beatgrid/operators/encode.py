"""Encoders and scalers, fitted on training rows and applied to any rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatgrid.functions.sums import exact_mean
from beatgrid.operators.counts import column_values
from beatgrid.operators.lookup import left_lookup
from beatgrid.session import materialize

Vocabulary = Mapping[str, Sequence[str]]

_POSITION_BITS = 33


def fit_vocabulary(df: DataFrame, *columns: str, most: int = 10_000) -> dict[str, list[str]]:
    """Ascending distinct values of each text column, from one pass over ``df``.

    For values that become names of columns or classes; they reach the driver, and more than ``most`` are refused
    with a ValueError. :func:`label_codes` and :func:`one_hot_vectors` handle columns of any cardinality.
    """
    distinct = column_values(df, *columns).where(F.col("value").isNotNull()).distinct()
    values = distinct.limit(most + 1).collect()
    if len(values) > most:
        raise ValueError(f"{', '.join(columns)}: over {most} values; use label_codes or one_hot_vectors")
    vocabulary: dict[str, list[str]] = {name: [] for name in columns}
    for name, value in values:
        vocabulary[name].append(value)
    return {name: sorted(found, key=lambda v: v.encode()) for name, found in vocabulary.items()}


def code_of(column: Column, values: Sequence[str]) -> Column:
    """Position of a value in ``values`` from 0; null for a value that is not there."""
    position = F.array_position(F.array(*(F.lit(value) for value in values)), column)
    return F.nullif(position, F.lit(0)) - 1


def label_encode(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Replace each column of the vocabulary by its code; null for values unseen in training."""
    return df.withColumns({name: code_of(F.col(name), values) for name, values in vocabulary.items()})


def value_codes(df: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """(column, value, code) of every distinct value of columns of one type, at any cardinality.

    The distinct values are range partitioned and sorted; a value's rank is its place in its partition plus the
    number of values in earlier partitions, and its code that rank less the column's first. Only the partition
    sizes are ranked in one task, and there are as many of those as partitions.
    """
    pairs = [F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").alias("value")) for name in columns]
    distinct = df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")
    distinct = distinct.where(F.col("value").isNotNull()).distinct()
    order = ("column", "value")
    ranged = distinct.repartitionByRange(partitions, *order) if partitions else distinct.repartitionByRange(*order)
    row_id = F.monotonically_increasing_id()
    placed = ranged.sortWithinPartitions(*order).select(
        *order,
        F.shiftright(row_id, _POSITION_BITS).alias("part"),
        row_id.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("place"),
    )
    placed = materialize(placed, "value-codes")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = "sum(n) over (order by part rows between unbounded preceding and 1 preceding)"
    offsets = sizes.select("part", F.coalesce(F.expr(before), F.lit(0)).alias("offset"))
    ranked = placed.join(F.broadcast(offsets), "part").withColumn("rank", F.col("place") + F.col("offset"))
    firsts = ranked.groupBy("column").agg(F.min("rank").alias("first"))
    return ranked.join(F.broadcast(firsts), "column").select(
        "column", "value", (F.col("rank") - F.col("first")).alias("code")
    )


def fit_codes(train: DataFrame, *columns: str) -> dict[str, tuple[DataFrame, int, int]]:
    """Per column: stored (value, code) rows, their size in bytes and their number; columns of one type together."""
    types: dict[str, list[str]] = {}
    for name in columns:
        types.setdefault(train.schema[name].dataType.simpleString(), []).append(name)
    fitted = {}
    for alike in types.values():
        table = materialize(value_codes(train, *alike), "codes")
        size = F.sum(F.octet_length(F.col("value").cast("string")) + 32)
        facts = table.groupBy("column").agg(size, F.count(F.lit(1))).collect()  # a row per column
        sizes = {name: (total, n) for name, total, n in facts}
        for name in alike:
            own = table.where(F.col("column") == name).select("value", "code")
            fitted[name] = (own, *sizes.get(name, (0, 0)))
    return fitted


def apply_codes(df: DataFrame, fitted: dict[str, tuple[DataFrame, int, int]], unseen: bool = False) -> DataFrame:
    """Replace columns by their fitted codes; an unknown value gets null, or with ``unseen`` the next free code."""
    code, names = {}, df.columns
    for name, (table, size, n) in fitted.items():
        own = table.select(F.col("value").alias(name), F.col("code").alias(f"_code_{name}"))
        df = left_lookup(df, own, name, size)
        found = F.col(f"`_code_{name}`")
        code[name] = F.coalesce(found, F.lit(n)) if unseen else found
    return df.select(*(code.get(n, F.col(f"`{n}`")).alias(n) for n in names))


def label_codes(train: DataFrame, df: DataFrame, *columns: str, unseen: bool = False) -> DataFrame:
    """``df`` with columns replaced by their codes among the values of ``train``, at any cardinality and type."""
    return apply_codes(df, fit_codes(train, *columns), unseen)


def one_hot_vectors(train: DataFrame, df: DataFrame, *columns: str) -> DataFrame:
    """Adds ``<column>_vector``: sparse 0/1 vectors with one place per training value, at any cardinality.

    A null or a value unseen in training gives a vector of zeros.
    """
    for name, (table, size, n) in fit_codes(train, *columns).items():
        index = f"_index_{name}"
        df = left_lookup(df, table.select(F.col("value").alias(name), F.col("code").alias(index)), name, size)
        df = df.withColumn(index, F.coalesce(F.col(f"`{index}`"), F.lit(n)).cast("double"))
        widest = df.sparkSession.createDataFrame([(float(n),)], f"`{index}` double")
        encoder = OneHotEncoder(inputCol=index, outputCol=f"{name}_vector", dropLast=True)  # the last place is unseen
        df = encoder.fit(widest).transform(df).drop(index)
    return df


def one_hot(df: DataFrame, vocabulary: Vocabulary, prefixes: Mapping[str, str]) -> DataFrame:
    """Replace each column of the vocabulary by one 0/1 column per training value."""
    kept = [F.col(f"`{name}`") for name in df.columns if name not in vocabulary]
    flags = [
        F.coalesce((F.col(f"`{name}`") == value).cast("int"), F.lit(0)).alias(f"{prefixes[name]}_{value}")
        for name, values in vocabulary.items()
        for value in values
    ]
    return df.select(*kept, *flags)


def mean_center(train: DataFrame, df: DataFrame, *columns: str) -> DataFrame:
    """Subtract the training mean of each column."""
    means = train.agg(F.struct(*(exact_mean(F.col(name)).alias(name) for name in columns))).scalar()
    shifted = {name: F.col(name) - F.col("_means")[name] for name in columns}
    return df.withColumn("_means", means).withColumns(shifted).drop("_means")


def moments(train: DataFrame, *columns: str) -> DataFrame:
    """One row: per column a struct of mean and population deviation, from sums around a rounded mean."""
    rough = train.agg(F.struct(*(F.round(F.avg(name), 3).alias(name) for name in columns))).scalar()
    apart = train.withColumn("_rough", rough)
    pairs = []
    for name in columns:
        shift = F.col("_rough")[name]
        away = F.col(name) - shift
        square = exact_mean(away * away)
        mean = exact_mean(away)
        spread = F.sqrt(F.greatest(F.lit(0.0), square - mean * mean))
        pairs.append(F.struct((F.max(shift) + mean).alias("mean"), spread.alias("deviation")).alias(name))
    return apart.agg(F.struct(*pairs).alias("moments"))


def standard_scale(train: DataFrame, df: DataFrame, *columns: str) -> DataFrame:
    """Subtract the training mean and divide by the training population deviation.

    A column that is constant in training is only shifted.
    """
    fitted = moments(train, *columns).scalar()

    def scaled(name: str) -> Column:
        moment = F.col("_moments")[name]
        divisor = F.when(moment["deviation"] == 0, F.lit(1.0)).otherwise(moment["deviation"])
        return (F.col(name) - moment["mean"]) / divisor

    return df.withColumn("_moments", fitted).withColumns({name: scaled(name) for name in columns}).drop("_moments")


def assemble(df: DataFrame, features: Sequence[str], *kept: str) -> DataFrame:
    """``kept`` columns and one vector column ``features``; names may hold any characters."""
    numbered = [f"_x{j}" for j in range(len(features))]
    doubles = [F.col(f"`{name}`").cast(T.DoubleType()).alias(x) for name, x in zip(features, numbered)]
    return (
        VectorAssembler(inputCols=numbered, outputCol="features")
        .transform(df.select(*kept, *doubles))
        .select(*kept, "features")
    )
