from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from beatgrid.operators import counts, rows
from beatgrid.operators.lookup import left_lookup
from beatgrid.operators.profile import fit_profile


@pytest.fixture(scope="module")
def incidents():
    """A third of all rows sits in one cell; some cells lack categories."""
    draw = random.Random(3)
    found = [(draw.choice([5, draw.randrange(40), draw.randrange(40)]), draw.choice("abcd")) for _ in range(600)]
    return found + [(99, "a"), (98, "e")]


@pytest.fixture(scope="module")
def train(spark, incidents):
    return spark.createDataFrame([(i, g, c) for i, (g, c) in enumerate(incidents)], "id bigint, GridNo bigint, Category_New string")


def test_profile_matches_counting(train, incidents):
    cells, totals = Counter(incidents), Counter(c for _, c in incidents)
    names = sorted(totals)
    profile = fit_profile(train)
    vectors = {row["GridNo"]: row["p"] for row in profile.vectors().collect()}
    assert vectors == {g: [cells[g, c] / totals[c] for c in names] for g in {g for g, _ in incidents}}
    long = {(r["GridNo"], r["Category_New"]): r["p"] for r in profile.long().collect()}
    assert long == {(g, c): cells[g, c] / totals[c] for g in vectors for c in names}
    for position in range(len(names)):
        assert abs(sum(v[position] for v in vectors.values()) - 1) < 1e-12
    missing = {tuple(r) for r in profile.missing().collect()}
    assert missing == {(g, c) for g in vectors for c in names if not cells[g, c]}
    filled = {(r["GridNo"], r["Category_New"]): r["n"] for r in profile.filled_counts().collect()}
    assert filled == {(g, c): float(cells[g, c]) for g in vectors for c in names}
    arrays = profile.arrays().where("GridNo = 99").first()
    assert arrays["categories"] == names and arrays["counts"] == [1, 0, 0, 0, 0]


def test_counts(spark, train, incidents):
    cells = Counter(incidents)
    pivot = counts.grid_category_pivot(train, ["a", "e"]).where("GridNo in (5, 98)").orderBy("GridNo").collect()
    assert [tuple(r) for r in pivot] == [(5, cells[5, "a"], 0), (98, 0, 1)]
    found = counts.distinct_counts(train, "GridNo", "Category_New").first()
    assert tuple(found) == (len({g for g, _ in incidents}), 5)
    with_null = spark.createDataFrame([(1.0,), (1.0,), (None,)], "X double")
    assert {tuple(r) for r in counts.non_null_counts(with_null, "X").collect()} == {(1.0, 2), (None, 0)}
    assert counts.distinct_counts(with_null, "X").first()["X"] == 1


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_attach_keeps_rows_and_fills_unseen_cells(spark, train, limit):
    test = spark.createDataFrame([(1, 5), (2, 99), (3, 1234), (4, None)], "id bigint, GridNo bigint")
    profile = fit_profile(train)
    attached = {r["id"]: r["ndArray"] for r in profile.attach(test, limit=limit).collect()}
    vectors = {row["GridNo"]: row["p"] for row in profile.vectors().collect()}
    assert attached == {1: vectors[5], 2: vectors[99], 3: [0.0] * 5, 4: [0.0] * 5}
    assert rows.row_count_check(train, profile.attach(train, limit=limit)).first()["ok"]


def test_small_profiles_are_broadcast_and_large_ones_salted(train):
    profile = fit_profile(train)
    plan = profile.attach(train)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    plan = profile.attach(train, limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "_salt" in plan and "NestedLoop" not in plan


def test_salted_lookup_spreads_a_hot_key(spark):
    hot = spark.range(2000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    table = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    salted = left_lookup(hot, table, "k", lookup_bytes=1, limit=0)
    plain = hot.join(table, "k", "left")
    assert salted.count() == 2000 and salted.exceptAll(plain.select(*salted.columns)).count() == 0


def test_profile_does_not_depend_on_partitions(train):
    a, b = fit_profile(train).long(), fit_profile(train.repartition(11)).long()
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
