from __future__ import annotations

import hashlib
import math
import threading

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from beatgrid.operators import boosting, classifiers, components, exact_tree, folds, kernel_svm, network, passes, singular
from beatgrid.operators import forest as forests
from beatgrid.operators.bayes import fit_gaussian_bayes, fit_naive_bayes
from beatgrid.operators.encode import fit_vocabulary
from beatgrid.operators.forest import fit_forest_in_blocks
from beatgrid.operators.evaluate import log_loss, long_form, score, true_probability
from beatgrid.plans import matrices, queries

FEATURES = ["x", "y"]
CLASSES = ["blue", "green", "red"]


@pytest.fixture(scope="module")
def data(spark):
    """Three separable clouds; the test part has one class unseen in training."""
    draw = np.random.default_rng(4)
    centres = {"blue": (1.0, 1.0), "green": (6.0, 2.0), "red": (3.0, 8.0)}
    rows = [
        (i, *(float(abs(v)) for v in draw.normal(centres[name], 0.5)), name)
        for i, name in enumerate(CLASSES * 60)
    ]
    df = spark.createDataFrame(rows, "id bigint, x double, y double, label string").repartition(3).cache()
    return df.where("id < 120"), df.where("id >= 120")


@pytest.fixture(scope="module")
def fit_rows(data):
    return classifiers.training_rows(data[0], FEATURES, "label", CLASSES)


def good(probabilities, bound=0.35):
    """Probabilities are complete, and better than the bound by log loss."""
    rows = probabilities.collect()
    assert len(rows) == 60
    for row in rows:
        assert row["classes"] == CLASSES and abs(sum(row["p"]) - 1) < 1e-9
    loss = score(probabilities, "label").first()["log_loss"]
    assert loss < bound < math.log(3)


def test_ml_models_separate_the_clouds(data, fit_rows):
    estimators = [
        classifiers.random_forest(trees=10, depth=4),
        classifiers.random_forest(trees=10, depth=4, features="log2"),
        classifiers.decision_tree(depth=3, min_leaf=2),
        classifiers.decision_tree(depth=4, min_leaf=5, features="all"),
        classifiers.logistic_regression(120, "l1", iterations=50),
        classifiers.logistic_regression(120, "l2", 0.6, iterations=50),
        classifiers.perceptron(2, 3),
    ]
    for estimator in estimators:
        model = estimator.fit(fit_rows)
        good(classifiers.predict_proba(model, data[1], FEATURES, CLASSES, "id", "label"))


def test_boosting(data, fit_rows):
    model = boosting.fit_boosted_trees(fit_rows, CLASSES, rounds=12, depth=1, rate=1.0)
    predicted = model.predict_proba(data[1], FEATURES, "id", "label")
    good(predicted, bound=1.0)
    best = F.array_position("p", F.array_max("p"))
    right = predicted.where(F.get("classes", (best - 1).cast("int")) == F.col("label")).count()
    assert right >= 57


def plain_tree(x, y, w, depth, n_classes):
    """A Gini tree by trying every threshold: nested (feature, threshold, left, right) or a class."""
    share = np.bincount(y, w, n_classes)
    best, found = (share**2).sum() / share.sum() * (1 + 1e-12), None
    if depth:
        for feature in range(x.shape[1]):
            values = np.unique(x[:, feature])
            for threshold in (values[:-1] + values[1:]) / 2:
                left = x[:, feature] <= threshold
                parts = [np.bincount(y[side], w[side], n_classes) for side in (left, ~left)]
                score = sum((part**2).sum() / part.sum() for part in parts)
                if score > best:
                    best, found = score, (feature, threshold)
    if found is None:
        return int(share.argmax())
    left = x[:, found[0]] <= found[1]
    return (*found, *(plain_tree(x[side], y[side], w[side], depth - 1, n_classes) for side in (left, ~left)))


def plain_class(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_samme(x, y, rounds, depth, rate, n_classes):
    w, out = np.ones(len(x)), []
    for _ in range(rounds):
        tree = plain_tree(x, y, w, depth, n_classes)
        missed = np.array([plain_class(tree, row) for row in x]) != y
        error = w[missed].sum() / w.sum()
        if error >= 1 - 1 / n_classes:
            break
        if error <= 0:
            return [*out, (tree, 1.0)]
        vote = rate * (math.log((1 - error) / error) + math.log(n_classes - 1))
        out.append((tree, vote))
        w = w * np.exp(vote * missed)
        w *= len(x) / w.sum()
    return out


@pytest.mark.parametrize("depth, rate", [(1, 1.0), (2, 1.5), (3, 0.5)])
def test_boosting_equals_plain_rounds(spark, depth, rate):
    draw = np.random.default_rng(depth)
    x = np.stack([draw.integers(0, 9, 300), draw.integers(0, 2, 300), draw.integers(0, 20, 300)], axis=1).astype(float)
    y = ((x[:, 0] > 4) + (x[:, 2] > 11) * x[:, 1] + (draw.random(300) < 0.3)).astype(int) % 4
    rows = [(float(label), Vectors.dense(values)) for label, values in zip(y, x)]
    train = spark.createDataFrame(rows, ["label", "features"]).repartition(3)
    model = boosting.fit_boosted_trees(train, ["a", "b", "c", "d"], rounds=60, depth=depth, rate=rate)
    plain = plain_samme(x, y, 60, depth, rate, 4)
    assert len(model.rounds) == len(plain) > 3
    assert np.allclose([one.vote for one in model.rounds], [vote for _, vote in plain], rtol=1e-4, atol=1e-4)
    votes = np.zeros((len(x), 4))
    for tree, vote in plain:
        votes[np.arange(len(x)), [plain_class(tree, row) for row in x]] += vote
    assert np.allclose(model.votes(x), votes, rtol=1e-3, atol=1e-2)


def test_boosting_stores_all_rows_in_blocks(fit_rows, monkeypatch):
    """Labels, bins and counts of every row come back, and a block holds many rows."""
    bins = boosting.fit_bins(fit_rows, 10)
    plain = [(int(r["label"]), bins(r["features"].toArray()[None, :])[0].tobytes()) for r in fit_rows.collect()]
    table = boosting._binned(fit_rows.unionByName(fit_rows).coalesce(1), bins).cache()
    found = []
    for block in table.toArrow().to_batches():
        for label, flat, n, w in passes.unpacked([block], *boosting.KINDS):
            assert len(label) <= passes.BLOCK_ROWS and (w == 1).all()
            found += [pair for *pair, m in zip(label, flat.reshape(-1, len(label)).T, n) for _ in range(m)]
    assert sorted((int(a), b.tobytes()) for a, b in found) == sorted(plain * 2)
    assert table.count() < len(set(plain)) / 2


def test_boosting_sums_are_exact():
    place = np.array([0, 1, 0])
    large = np.array([2**60 + 1, 5, 2])
    assert boosting._added(place, large, 3).tolist() == [2**60 + 3, 5, 0]
    assert boosting._added(place, np.array([3.0, 5.0, 2.0]), 3).tolist() == [5, 5, 0]


def test_boosting_is_the_same_on_any_layout(spark, fit_rows):
    one, two = (
        boosting.fit_boosted_trees(rows, CLASSES, rounds=40)
        for rows in (fit_rows.repartition(1), fit_rows.repartition(7))
    )
    assert [r.vote for r in one.rounds] == [r.vote for r in two.rounds]


def test_bins_are_values_or_equally_filled(spark):
    rows = [(Vectors.dense(float(i % 3), float(i)),) for i in range(1_000)]
    bins = boosting.fit_bins(spark.createDataFrame(rows, ["features"]), 10)
    assert bins.thresholds[0].tolist() == [0.5, 1.5] and bins.width == 10
    found = bins(np.array([[i % 3, i] for i in range(1_000)], dtype=float))
    assert (found[:, 0] == np.arange(1_000) % 3).all()
    assert abs(np.bincount(found[:, 1]) - 100).max() <= 1


def test_kernel_svm(data):
    model = kernel_svm.fit_kernel_svm(data[0], FEATURES, "label", CLASSES, 120, iterations=10, outputs=32)
    good(model.predict_proba(data[1], "id", "label"), bound=0.8)


def test_margins_are_at_the_least_loss_of_each_class(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(200, 2))
    y = np.where(x[:, 0] ** 2 + x[:, 1] ** 2 < 1, 0, np.where(x[:, 0] > 0, 1, 2))
    rows = [(*map(float, v), CLASSES[k]) for v, k in zip(x, y)]
    train = spark.createDataFrame(rows, "x double, y double, label string").repartition(4)
    model = kernel_svm.fit_kernel_svm(train, FEATURES, "label", CLASSES, 200, outputs=24, tolerance=1e-12)
    waves = model.projection.waves(x)
    for k in range(3):  # each class alone
        side = np.where(y == k, 1.0, -1.0)
        margin = side * (waves @ model.weights[:, k] + model.offsets[k])
        bend = kernel_svm.rounded_hinge(margin)[1] * side
        slope = waves.T @ bend / 200 + model.weights[:, k] / 200
        assert abs(slope).max() < 1e-3 and abs(bend.mean()) < 1e-3
    found = model.predict_proba(train, "x", "y", "label").collect()
    assert np.mean([CLASSES[int(np.argmax(r["p"]))] == r["label"] for r in found]) > 0.93


def test_rounded_hinge():
    t = np.linspace(-3, 4, 701)
    loss, bend = kernel_svm.rounded_hinge(t)
    assert np.allclose(loss[t < 0.5], 1 - t[t < 0.5]) and not loss[t > 1.5].any()
    assert np.allclose(np.gradient(loss, t)[1:-1], bend[1:-1], atol=0.01)


def test_minimise_finds_the_least_value():
    scale = np.array([1.0, 50.0, 0.1])
    found = kernel_svm.minimise(lambda v: (float((scale * (v - 2) ** 2).sum()), 2 * scale * (v - 2)), np.zeros(3), 60, 0.0)
    assert np.allclose(found, 2, atol=1e-4)


def plain_exact_tree(x, y, n_classes, depth, min_leaf, min_split, allowed, node=1):
    """node -> (feature, threshold) and node -> class counts."""
    own = np.bincount(y, minlength=n_classes)
    splits, counts = {}, {node: own.tolist()}
    best, found = (own**2).sum() / max(1, own.sum()) + 1e-9, None
    if depth and own.sum() >= min_split and (own > 0).sum() > 1:
        for feature in allowed(node):
            values = np.unique(x[:, feature])
            for threshold in (values[:-1] + values[1:]) / 2:
                left = x[:, feature] <= threshold
                if min(left.sum(), (~left).sum()) >= min_leaf:
                    parts = [np.bincount(y[side], minlength=n_classes) for side in (left, ~left)]
                    score = sum((part**2).sum() / part.sum() for part in parts)
                    if score > best:
                        best, found = score, (feature, threshold)
    if found:
        splits[node] = found
        left = x[:, found[0]] <= found[1]
        for side, child in ((left, 2 * node), (~left, 2 * node + 1)):
            more = plain_exact_tree(x[side], y[side], n_classes, depth - 1, min_leaf, min_split, allowed, child)
            splits.update(more[0])
            counts.update(more[1])
    return splits, counts


@pytest.mark.parametrize("depth, min_leaf, min_split, pick", [(2, 20, 100, "sqrt"), (4, 5, 2, "all"), (3, 1, 2, "sqrt")])
def test_exact_tree_equals_trying_every_threshold(spark, depth, min_leaf, min_split, pick):
    draw = np.random.default_rng(depth)
    names = ["a", "b", "c", "d", "e"]
    x = np.stack([draw.integers(0, 300, 600), draw.normal(size=600), *(draw.integers(0, 4, 600) for _ in range(3))], axis=1)
    y = ((x[:, 0] > 120).astype(int) + (x[:, 1] > 0.3) * (x[:, 2] > 1) + (draw.random(600) < 0.2)) % 3
    rows = [(*map(float, v), CLASSES[k]) for v, k in zip(x, y)]
    train = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", label string").repartition(6)
    tree = exact_tree.fit_exact_tree(train, names, "label", CLASSES, depth, min_leaf, min_split, pick, seed=7)
    how_many = 5 if pick == "all" else 2
    splits, counts = plain_exact_tree(
        x, y, 3, depth, min_leaf, min_split, lambda node: exact_tree.drawn_features(names, node, 7, how_many)
    )
    assert splits and {n: (s.feature, s.threshold) for n, s in tree.splits.items()} == splits
    assert tree.counts == counts
    found = tree.predict_proba(train, "label").agg(F.sum(F.get("p", F.lit(0)))).first()[0]
    assert math.isclose(found, (y == 0).sum())
    ranked = tree.importances(spark).collect()
    assert len(ranked) == 5 and math.isclose(sum(r["importance"] for r in ranked), 1)


def test_exact_tree_without_a_split(spark):
    train = spark.createDataFrame([(1.0, "blue"), (1.0, "red")], "x double, label string")
    tree = exact_tree.fit_exact_tree(train, ["x"], "label", CLASSES, min_leaf=1, min_split=2)
    assert not tree.splits and tree.predict_proba(train).first()["p"] == [0.5, 0.0, 0.5]


def test_fourier_features_approach_the_kernel():
    features = kernel_svm.fourier_features(3, outputs=20_000, gamma=0.4)
    x = np.random.default_rng(2).normal(size=(6, 3))
    waves = np.cos(x @ features.directions + features.phases) * np.sqrt(2 / len(features.phases))
    exact = np.exp(-0.4 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(waves @ waves.T - exact).max() < 0.05


def test_naive_bayes_by_hand(spark):
    train = [(1.0, 3.0, "a"), (2.0, 0.0, "a"), (0.0, 5.0, "b")]
    df = spark.createDataFrame(train, "x double, y double, label string")
    test = spark.createDataFrame([(0, 2.0, 1.0)], "id int, x double, y double")
    found = fit_naive_bayes(df, FEATURES, "label", 0.01).predict_proba(test, "id").first()
    joint = []
    for name in ("a", "b"):
        rows = [r for r in train if r[2] == name]
        sums = [sum(r[j] for r in rows) + 0.01 for j in (0, 1)]
        joint.append(math.log(len(rows) / 3) + sum(v * math.log(s / sum(sums)) for v, s in zip((2.0, 1.0), sums)))
    shares = [math.exp(j - max(joint)) for j in joint]
    assert found["classes"] == ["a", "b"]
    assert np.allclose(found["p"], [s / sum(shares) for s in shares])


def test_naive_bayes_is_close_to_the_library_model(data, fit_rows):
    ours = fit_naive_bayes(data[0], FEATURES, "label").predict_proba(data[1], "id")
    model = classifiers.naive_bayes().fit(fit_rows)
    theirs = classifiers.predict_proba(model, data[1], FEATURES, CLASSES, "id")
    left = {r["id"]: r["p"] for r in ours.collect()}
    for row in theirs.collect():
        assert np.allclose(row["p"], left[row["id"]], atol=1e-3)


def test_log_loss(spark):
    rows = [("a", 0.25), ("b", 0.75), ("new", None), ("a", 0.0), ("b", 1.0)]
    df = spark.createDataFrame(rows, "label string, t double")
    expected = -(math.log(0.25) + math.log(0.75) + 2 * math.log(1e-15) + math.log(1 - 1e-15)) / 5
    assert math.isclose(df.agg(log_loss(F.col("t"))).first()[0], expected)
    arrays = df.select("label", F.array(F.lit("a"), F.lit("b")).alias("classes"), F.array(F.lit(0.3), F.lit(0.7)).alias("p"))
    assert [r[0] for r in arrays.select(true_probability(F.col("label"))).collect()] == [0.3, 0.7, None, 0.3, 0.7]
    assert long_form(arrays, "label").count() == 10


def test_importance_search_and_folds(spark, data, fit_rows):
    model = classifiers.random_forest(trees=5, depth=3).fit(fit_rows)
    ranked = classifiers.feature_importance(spark, model, FEATURES).collect()
    assert [r["rank"] for r in ranked] == [1, 2] and abs(sum(r["importance"] for r in ranked) - 1) < 1e-9
    assert ranked[0]["importance"] >= ranked[1]["importance"]
    searched = classifiers.grid_search(fit_rows, depths=(1, 3), trees=(3,), leaves=(1, 5), folds=2).collect()
    assert len(searched) == 4 and sum(r["is_best"] for r in searched) == 1
    best = next(r for r in searched if r["is_best"])
    assert best["accuracy"] == max(r["accuracy"] for r in searched) > 0.9
    folds = classifiers.cross_validate(fit_rows, classifiers.random_forest(trees=5, depth=3)).first()
    assert folds["folds"] == 4 and folds["mean_score"] > 0.9


def test_projection_is_centred_and_ordered(data):
    rows = data[0].select(*FEATURES)
    x = np.array([tuple(r) for r in rows.collect()])
    found, again = (components.fit_components(part, FEATURES, 2) for part in (rows.repartition(1), rows.repartition(7)))
    assert (found.loadings == again.loadings).all() and (found.means == again.means).all()
    projected = np.array([tuple(r) for r in rows.select(*found.values()).collect()])
    assert np.allclose(projected.mean(axis=0), 0, atol=1e-9)
    spread = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(found.variances, spread) and np.allclose(projected.var(axis=0, ddof=1), spread)
    assert np.allclose(components.covariance(rows, FEATURES)[1], np.cov(x.T))
    assert (found.loadings[np.abs(found.loadings).argmax(axis=0), [0, 1]] > 0).all()
    assert fit_vocabulary(data[0], "label")["label"] == CLASSES


def test_folds_follow_the_key(spark, data):
    rows = folds.with_fold(data[0], "id", 4)
    found = {r["id"]: r["fold"] for r in rows.collect()}
    assert found == {r["id"]: r["fold"] for r in folds.with_fold(data[0].repartition(5), "id", 4).collect()}
    assert found == {i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 4 for i in found}

    def predict(train, test):
        return fit_naive_bayes(train, FEATURES, "label").predict_proba(test, "label")

    for row in folds.fold_accuracy(rows, "label", 4, predict).collect():
        own = predict(rows.where(F.col("fold") != row["fold"]), rows.where(F.col("fold") == row["fold"])).collect()
        right = sum(r["classes"][int(np.argmax(r["p"]))] == r["label"] for r in own)
        assert (row["n"], row["right"]) == (len(own), right) and right > 0.4 * len(own) > 0


def test_forest_in_blocks(spark, data, fit_rows, tmp_path):
    """Blocks are the single forests, their mean is the result, and a second run fits none of them again."""
    settings = {"trees": 7, "depth": 3, "block": 3, "folder": str(tmp_path / "forest")}
    forest = fit_forest_in_blocks(fit_rows, **settings)
    assert [n for _, n in forest.blocks] == [3, 3, 1]
    written = sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "forest").rglob("*"))
    assert fit_forest_in_blocks(fit_rows, **settings) == forest
    assert written == sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "forest").rglob("*"))
    found = forest.predict_proba(data[1], FEATURES, CLASSES, "id", "label")
    good(found)
    total: dict = {}
    for start, n in ((0, 3), (3, 3), (6, 1)):
        model = classifiers.random_forest(n, 3, seed=10 + start).fit(fit_rows)
        for row in classifiers.predict_proba(model, data[1], FEATURES, CLASSES, "id").collect():
            total[row["id"]] = total.get(row["id"], 0) + np.array(row["p"]) * n / 7
    for row in found.collect():
        assert np.allclose(row["p"], total[row["id"]])


def test_stored_rows_lie_in_the_same_tasks_on_any_layout(spark, data):
    names = {"x": F.col("x"), matrices.KEY: F.col("id"), matrices.LABEL: F.col("label")}
    rows = data[0].select(*(column.alias(name) for name, column in names.items()))
    for many in (1, 9):
        table = matrices._stored(rows.repartition(many), "layout")
        found = [[r[matrices.KEY] for r in part] for part in table.rdd.glom().collect()]
        assert many == 1 or found == before
        before = found


def test_forests_get_few_and_large_tasks(spark):
    """Small tables lie as before; beyond that a forest's statistics are not made and sent by 64 tasks."""
    for n, few, many in ((3_500, 4, 4), (20_000, 12, 20)):
        rows = spark.range(n).select(F.col("id").alias(matrices.KEY), F.lit("red").alias(matrices.LABEL))
        data = matrices.Matrices(rows, rows.limit(5), [], ["red"])
        for layout, tasks in ((matrices.FORESTS, few), (matrices.PASSES, many)):
            train = data.stored(layout).train
            assert train.rdd.getNumPartitions() == tasks and train.distinct().count() == n


def test_blocks_are_fitted_together(fit_rows, tmp_path, monkeypatch):
    """Two fits wait for each other; a driver with little memory fits one block at a time."""
    both = threading.Barrier(2, timeout=60)
    plain = forests.random_forest

    class Meeting:
        def __init__(self, *settings):
            self.forest = plain(*settings)

        def fit(self, rows):
            both.wait()
            return self.forest.fit(rows)

    monkeypatch.setattr(forests, "random_forest", Meeting)
    monkeypatch.setattr(forests, "BLOCK_BYTES", 1, raising=False)
    found = fit_forest_in_blocks(fit_rows, trees=8, depth=2, block=2, folder=str(tmp_path / "forest"))
    assert [n for _, n in found.blocks] == [2, 2, 2, 2] and len({path for path, _ in found.blocks}) == 4
    monkeypatch.setattr(forests, "BLOCK_BYTES", 2**62)
    assert forests._at_once(fit_rows.sparkSession) == 1


def test_blocks_get_fewer_tasks_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr(matrices, "DEEP_ROWS", 4_000)
    for n, stored, tasks in ((3_500, 4, 4), (21_000, 12, 6), (49_000, 12, 12)):
        rows = spark.range(n).select(F.col("id").alias(matrices.KEY), F.lit("red").alias(matrices.LABEL))
        data = matrices.Matrices(rows, rows.limit(5), [], ["red"]).stored(matrices.FORESTS)
        train = data.for_blocks().train
        assert (data.train.rdd.getNumPartitions(), train.rdd.getNumPartitions()) == (stored, tasks)
        assert train.distinct().count() == n


@pytest.mark.parametrize("name", ["rf_proba", "holdout_logloss", "rf_proba_one_hot"])
def test_forests_in_blocks_deal_their_rows_for_blocks(spark, folder, monkeypatch, name):
    class Dealt(Exception):
        pass

    def dealt(data):
        raise Dealt

    monkeypatch.setattr(matrices.Matrices, "for_blocks", dealt, raising=False)
    with pytest.raises(Dealt):
        queries.QUERIES[name](spark, folder)


@pytest.mark.parametrize(
    "name", ["rf_proba", "grid_search", "holdout_logloss", "pca_forest", "rf_proba_one_hot", "rf_proba_log2"]
)
def test_forest_queries_deal_their_rows_for_a_forest(spark, folder, monkeypatch, name):
    class Dealt(Exception):
        pass

    def stored(df, name, layout=None):
        raise Dealt(layout)

    monkeypatch.setattr(matrices, "_stored", stored)
    with pytest.raises(Dealt) as dealt:
        queries.QUERIES[name](spark, folder)
    assert dealt.value.args == (matrices.FORESTS,)


def test_the_established_settings_are_the_defaults():
    assert fit_forest_in_blocks.__defaults__[:2] == (700, 13)
    assert boosting.fit_boosted_trees.__defaults__[:3] == (600, 2, 1.5)
    assert exact_tree.fit_exact_tree.__defaults__ == (2, 20, 100, "sqrt", 100)


def test_gaussian_bayes_equals_densities_by_hand(spark, data):
    found = {r["id"]: r["p"] for r in fit_gaussian_bayes(data[0], FEATURES, "label").predict_proba(data[1], "id").collect()}
    train = [tuple(r) for r in data[0].select("label", *FEATURES).collect()]
    x, y = np.array([r[1:] for r in train]), np.array([CLASSES.index(r[0]) for r in train])
    raised = 1e-9 * x.var(axis=0).max()
    for row in data[1].collect():
        at = np.array([row["x"], row["y"]])
        score = []
        for k in range(3):
            own = x[y == k]
            m, s = own.mean(axis=0), own.var(axis=0) + raised
            score.append(np.log((y == k).mean()) - 0.5 * (np.log(2 * np.pi * s) + (at - m) ** 2 / s).sum())
        shares = np.exp(np.array(score) - max(score))
        assert np.allclose(found[row["id"]], shares / shares.sum(), atol=1e-6)
    good(fit_gaussian_bayes(data[0], FEATURES, "label").predict_proba(data[1], "id", "label"))


def test_singular_vectors_equal_a_plain_decomposition(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(200, 3)) @ draw.normal(size=(3, 9)) * 3 + draw.normal(size=(200, 9)) * 0.1 + 2
    names = [f"f{i}" for i in range(9)]
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], names).repartition(4)
    found = singular.fit_singular(rows, names, 3)
    _, values, vectors = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(found.values, values[:3], rtol=1e-4)
    assert np.allclose(abs((found.vectors * vectors[:3].T).sum(axis=0)), 1, atol=1e-4)
    projected = np.array([tuple(r) for r in rows.select(*found.projections()).collect()])
    assert np.allclose(np.sqrt((projected**2).sum(axis=0)), values[:3], rtol=1e-4)


def test_network_equals_plain_steps(spark, data):
    network_ = network.fit_network(data[0], FEATURES, "label", "id", CLASSES, hidden=5, epochs=30, rate=0.05)
    rows = [tuple(r) for r in data[0].select("label", *FEATURES).collect()]
    x, y = np.array([r[1:] for r in rows]), np.array([CLASSES.index(r[0]) for r in rows])
    w1, b1, w2, b2 = (part.copy() for part in network.Layers.drawn(2, 5, 3, 10).parts)
    means, squares = [[np.zeros_like(p) for p in (w1, b1, w2, b2)] for _ in range(2)]
    for t in range(1, 31):
        before = x @ w1 + b1
        hidden = before * (before > 0)
        p = np.exp(hidden @ w2 + b2)
        p /= p.sum(axis=1, keepdims=True)
        error = (p - np.eye(3)[y]) / len(x)
        back = error @ w2.T * (before > 0)
        for i, (part, slope) in enumerate(zip((w1, b1, w2, b2), (x.T @ back, back.sum(0), hidden.T @ error, error.sum(0)))):
            means[i] = 0.9 * means[i] + 0.1 * slope
            squares[i] = 0.999 * squares[i] + 0.001 * slope**2
            part -= 0.05 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * means[i] / (np.sqrt(squares[i]) + 1e-7)
    for found, own in zip(network_.layers.parts, (w1, b1, w2, b2)):
        assert np.allclose(found, own, atol=1e-5)


def test_network_stores_its_rows_in_blocks(data, monkeypatch):
    """A full batch reads blocks, small ones too, and all rows are in them."""
    read = []
    summed = network.summed

    def watched(rows, *settings):
        read.append(rows)
        assert sorted(rows.columns) == ["label", "x"] and rows.schema["x"].dataType.typeName() == "binary"
        sums = summed(rows, *settings)
        assert sums[-1] == 120
        return sums

    monkeypatch.setattr(network, "summed", watched)
    network.fit_network(data[0], FEATURES, "label", "id", CLASSES, epochs=2)
    assert len(read) == 2


def test_network_slope_by_tiles(monkeypatch):
    draw = np.random.default_rng(2)
    x, label = draw.normal(size=(50, 4)), draw.integers(0, 3, 50)
    layers = network.Layers.drawn(4, 5, 3, 1)
    whole = layers.slope(x, label)
    monkeypatch.setattr(network, "TILE", 7)
    assert np.allclose(layers.slope(x, label), whole, atol=1e-12)


def test_network_in_smaller_steps(data):
    network_ = network.fit_network(data[0], FEATURES, "label", "id", CLASSES, epochs=40, steps=3, rate=0.05)
    good(network_.predict_proba(data[1], "id", "label"))


class _Counted:
    """An estimator that counts the fits of another."""

    def __init__(self, estimator):
        self.estimator, self.fits = estimator, []

    def fit(self, rows):
        self.fits.append(rows.count())
        return self.estimator.fit(rows)


def test_cross_validation_fits_each_fold_once(spark, fit_rows):
    """The scores are those of Spark's validator, whose further fit to all rows is not made."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rows = fit_rows.withColumn("fold", (F.monotonically_increasing_id() % 4).cast("int")).localCheckpoint()
    tree = classifiers.decision_tree(depth=2, features="all")
    expected = CrossValidator(
        estimator=tree,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=4,
        foldCol="fold",
    ).fit(rows)
    counted = _Counted(tree)
    found = classifiers.cross_validate(rows, counted).first()
    assert len(counted.fits) == 4 and sum(counted.fits) == 3 * rows.count()
    assert (found["mean_score"], found["std_score"]) == pytest.approx((expected.avgMetrics[0], expected.stdMetrics[0]), abs=1e-12)
    with pytest.raises(Exception, match="in none of 2 folds"):
        classifiers.cross_validate(rows, tree, folds=2)


def test_grid_search_fits_each_setting_once_to_each_fold(fit_rows, monkeypatch):
    """The scores are those of Spark's validator, whose further fit to all rows is not made."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rows = fit_rows.withColumn("fold", (F.monotonically_increasing_id() % 3).cast("int")).localCheckpoint()
    forest = classifiers.random_forest(features="log2")
    grid = ParamGridBuilder().addGrid(forest.maxDepth, [1, 3]).addGrid(forest.numTrees, [2]).addGrid(forest.minInstancesPerNode, [1, 30])
    judge = MulticlassClassificationEvaluator(metricName="accuracy")
    expected = CrossValidator(
        estimator=forest, estimatorParamMaps=grid.build(), evaluator=judge, numFolds=3, foldCol="fold"
    ).fit(rows)
    fits, plain = [], RandomForestClassifier._fit

    def counted(own, data):
        fits.append((data.count(), own.getCacheNodeIds()))
        return plain(own, data)

    monkeypatch.setattr(RandomForestClassifier, "_fit", counted)
    found = classifiers.grid_search(rows, depths=(1, 3), trees=(2,), leaves=(1, 30)).collect()
    assert len(fits) == 12 and sum(n for n, _ in fits) == 8 * rows.count() and not any(kept for _, kept in fits)
    assert [r["accuracy"] for r in found] == pytest.approx(expected.avgMetrics, abs=1e-12)
    with pytest.raises(Exception, match="in none of 2 folds"):
        classifiers.grid_search(rows, (1,), (2,), (1,), folds=2)
