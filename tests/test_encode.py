from __future__ import annotations

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from beatgrid.operators import encode
from beatgrid.operators.density import kernel_density


def test_vocabulary_and_codes(spark):
    train = spark.createDataFrame([("b", "x"), ("a", "y"), ("É", None), ("b", "x")], "s string, t string")
    test = spark.createDataFrame([("b", "y"), ("new", "x"), (None, None)], "s string, t string")
    vocabulary = encode.fit_vocabulary(train, "s", "t")
    assert vocabulary == {"s": ["a", "b", "É"], "t": ["x", "y"]}
    assert [tuple(r) for r in encode.label_encode(test, vocabulary).collect()] == [(1, 1), (None, 0), (None, None)]
    hot = encode.one_hot(test, {"s": vocabulary["s"]}, {"s": "p"})
    assert hot.columns == ["t", "p_a", "p_b", "p_É"]
    assert [tuple(r)[1:] for r in hot.collect()] == [(0, 1, 0), (0, 0, 0), (0, 0, 0)]


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_value_codes_are_dense_ranks(spark, partitions):
    words = [f"w{(i * 7919) % 1000:04d}" for i in range(3000)]
    df = spark.createDataFrame([(w,) for w in [*words, None]], "w string")
    codes = {r["value"]: r["code"] for r in encode.value_codes(df, "w", partitions=partitions).collect()}
    assert codes == {w: i for i, w in enumerate(sorted(set(words)))}


def test_label_codes_of_any_type_and_number(spark):
    train = spark.createDataFrame(
        [(i % 400, f"a{i % 400:03d}", f"b{i % 400:03d}", f"wide{i:05d}", i / 4) for i in range(5000)],
        "n int, `a.b` string, t string, w string, x double",
    )
    df = spark.createDataFrame(
        [(7, "a007", "b399", "wide04999", 2.0), (-1, "?", None, "wide00000", 2.1)],
        "n int, `a.b` string, t string, w string, x double",
    )
    names = ("n", "a.b", "t", "w", "x")
    assert [tuple(r) for r in encode.label_codes(train, df, *names).orderBy("w").collect()] == [
        (None, None, None, 0, None),
        (7, 7, 399, 4999, 8),
    ]
    assert tuple(encode.label_codes(train, df, *names, unseen=True).orderBy("w").first()) == (400, 400, 400, 0, 5000)


def test_label_codes_do_not_depend_on_the_join(spark, monkeypatch):
    train = spark.createDataFrame([(f"v{i % 50}",) for i in range(200)], "w string")
    df = spark.createDataFrame([(f"v{i}", i) for i in range(60)], "w string, i int")
    small = encode.label_codes(train, df, "w").orderBy("i").collect()
    left = encode.left_lookup
    monkeypatch.setattr(encode, "left_lookup", lambda *a: left(*a, limit=0))
    assert encode.label_codes(train, df, "w").orderBy("i").collect() == small
    assert sum(row["w"] is None for row in small) == 10


def test_names_and_values_with_dots(spark):
    df = spark.createDataFrame([("a.b", 1.0), ("c", 2.0)], "s string, `x.y` double")
    hot = encode.one_hot(df, {"s": ["a.b", "c"]}, {"s": "p"})
    assembled = encode.assemble(hot, hot.columns)
    assert [list(r["features"].toArray()) for r in assembled.collect()] == [[1.0, 1.0, 0.0], [2.0, 0.0, 1.0]]


def test_one_hot_vectors(spark):
    train = spark.createDataFrame([(f"v{i:04d}",) for i in range(3000)], "s string")
    df = spark.createDataFrame([("v0002",), ("new",), (None,)], "s string")
    vectors = {r["s"]: r["s_vector"] for r in encode.one_hot_vectors(train, df, "s").collect()}
    assert vectors["v0002"].size == 3000 and list(vectors["v0002"].indices) == [2]
    assert vectors["new"].numNonzeros() == 0 and vectors[None].numNonzeros() == 0


def test_scaling_uses_training_rows(spark):
    xs = [1.0, 2.0, 4.0, 9.0]
    train = spark.createDataFrame([(x, 7.0) for x in xs], "x double, c double")
    test = spark.createDataFrame([(5.0, 8.0)], "x double, c double")
    row = encode.standard_scale(train, test, "x", "c").first()
    assert math.isclose(row["x"], (5 - 4) / statistics.pstdev(xs)) and row["c"] == 1.0
    assert tuple(encode.mean_center(train, test, "x", "c").first()) == (1.0, 1.0)
    plan = encode.standard_scale(train, test, "x")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_density_matches_the_formula(spark):
    draw = np.random.default_rng(1)
    xs = np.round(draw.normal(3, 2, 300), 1)
    ys = draw.integers(0, 5, 300).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(xs, ys)], "x double, y double")
    found = kernel_density(df, "x", "y", points=20).collect()
    for name, sample in (("x", xs), ("y", ys)):
        h = sample.std(ddof=1) * len(sample) ** -0.2
        grid = np.linspace(sample.min() - 3 * h, sample.max() + 3 * h, 20)
        density = np.exp(-0.5 * ((grid[:, None] - sample) / h) ** 2).sum(axis=1) / (len(sample) * h * np.sqrt(2 * np.pi))
        rows = sorted((r for r in found if r["feature"] == name), key=lambda r: r["point"])
        assert np.allclose([r["x"] for r in rows], grid) and np.allclose([r["density"] for r in rows], density)


def test_density_of_a_constant_is_null(spark):
    df = spark.range(5).select(F.lit(2.0).alias("x"))
    assert {r["density"] for r in kernel_density(df, "x", points=3).collect()} == {None}


def test_too_many_values_for_columns_are_refused(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("s"))
    assert len(encode.fit_vocabulary(df, "s", most=30)["s"]) == 30
    with pytest.raises(ValueError, match="label_codes"):
        encode.fit_vocabulary(df, "s", most=29)
