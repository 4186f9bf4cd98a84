"""Named queries: (session, table folder) to DataFrame, all over whole tables.

Incidents come from ``orders``; training rows are those up to 1998, test rows the later ones. Doubles
that depend on the order of a sum are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatgrid.functions import arrays, categories, dates, places
from beatgrid.operators import boosting, classifiers, columns, counts, encode, evaluate, kernel_svm, neighbours, rows
from beatgrid.operators.bayes import fit_gaussian_bayes, fit_naive_bayes
from beatgrid.operators.components import Components, covariance, fit_components
from beatgrid.operators.density import kernel_density
from beatgrid.operators.exact_tree import ExactTree, fit_exact_tree
from beatgrid.operators.folds import fold_accuracy, with_fold
from beatgrid.operators.forest import StoredForest, fit_forest_in_blocks
from beatgrid.operators.network import fit_network
from beatgrid.operators.profile import fit_profile
from beatgrid.operators.singular import fit_singular
from beatgrid.plans.features import REQUIRED, add_features, build_features, decompose_dates
from beatgrid.plans.matrices import FORESTS, KEY, LABEL, PASSES, Matrices, label_encoded_matrices, one_hot_matrices
from beatgrid.schemas import FEATURES, RAW_INCIDENTS
from beatgrid.session import fresh_path, materialize
from beatgrid.sources import jsonlines
from beatgrid.sources.delimited import read_csv, read_well_formed_csv, write_csv
from beatgrid.sources.incidents import LAST_TRAIN_YEAR, incidents
from beatgrid.sources.parquet import read_table

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 8
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[function.__name__] = function
    return function


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return build_features(incidents(spark, folder))


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return rows.split_by_year(_features(spark, folder), LAST_TRAIN_YEAR)


def _train(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder)[0]


def _decomposed(spark: SparkSession, folder: str) -> DataFrame:
    return decompose_dates(incidents(spark, folder))


def _rounded(column: str | Column) -> Column:
    return F.round(column, DIGITS)


def _elements(df: DataFrame, values: str, *kept: str) -> DataFrame:
    """(kept columns, pos, p) of an array column."""
    return df.select(*kept, F.posexplode(values).alias("pos", "p")).withColumn("p", _rounded("p"))


def _long(probabilities: DataFrame) -> DataFrame:
    return evaluate.long_form(probabilities, KEY).withColumn("p", _rounded("p"))


# Sources and sinks


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "features-csv")
    write_csv(_features(spark, folder), path)
    return read_csv(spark, path, FEATURES)


@query
def csv_dropmalformed(spark: SparkSession, folder: str) -> DataFrame:
    """Some lines end early and some hold text where a number belongs; neither kind is read."""
    raw = incidents(spark, folder)
    whole = F.to_csv(F.struct(*raw.columns))
    cut = F.concat_ws(",", F.col("IncidntNum").cast("string"), F.lit("cut"))
    wrong = F.concat(whole, F.lit("x"))
    key = F.col("IncidntNum")
    line = F.when(key % 31 == 0, cut).when(key % 29 == 0, wrong).otherwise(whole)
    header = ",".join(raw.columns)

    def with_header(batches):
        yield pd.DataFrame({"value": [header]})
        yield from batches

    path = fresh_path(spark, "incidents-csv")
    raw.select(line.alias("value")).mapInPandas(with_header, "value string").write.text(path)
    return read_well_formed_csv(spark, path, RAW_INCIDENTS)


@query
def csv_existing_path(spark: SparkSession, folder: str) -> DataFrame:
    """A sink that refuses a path that is there: nothing of the second table is written."""
    path = fresh_path(spark, "once-csv")
    write_csv(_train(spark, folder), path, mode="errorifexists")
    try:
        write_csv(_features(spark, folder), path, mode="errorifexists")
        refused = False
    except AnalysisException as error:
        refused = error.getCondition() == "PATH_ALREADY_EXISTS"
    return read_csv(spark, path, FEATURES).agg(F.lit(refused).alias("refused"), F.count("*").alias("n"))


@query
def rows_to_json(spark: SparkSession, folder: str) -> DataFrame:
    return jsonlines.rows_to_json(_features(spark, folder))


@query
def preview_limit(spark: SparkSession, folder: str) -> DataFrame:
    return rows.preview(_train(spark, folder), 5, KEY)


# Projections and filters


@query
def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return _features(spark, folder)


@query
def category_by_season(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship report: incidents per refined category and season."""
    return counts.value_counts(_features(spark, folder), "Category_New", "Season")


@query
def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    return columns.drop_columns(_train(spark, folder), columns.NOT_IN_LABEL_ENCODED)


@query
def drop_columns_reduced(spark: SparkSession, folder: str) -> DataFrame:
    return columns.drop_columns(_train(spark, folder), columns.NOT_IN_REDUCED)


@query
def struct_expand(spark: SparkSession, folder: str) -> DataFrame:
    packed = columns.pack(_train(spark, folder), "row", "Season")
    return columns.unpack(packed, "row")


@query
def exclude_categories(spark: SparkSession, folder: str) -> DataFrame:
    return rows.exclude_categories(incidents(spark, folder)).select("IncidntNum", "Category")


@query
def bbox_filter(spark: SparkSession, folder: str) -> DataFrame:
    return rows.within_extent(incidents(spark, folder)).select("IncidntNum", "X")


@query
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    split = rows.with_split(_decomposed(spark, folder), LAST_TRAIN_YEAR)
    return split.select("IncidntNum", "Year", "split")


@query
def drop_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    complete = rows.drop_null_rows(_decomposed(spark, folder), *REQUIRED)
    return add_features(complete).select("PdId", "Category_New", "GridNo", "Y")


@query
def select_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return columns.strings_then_numbers(_train(spark, folder))


# Scalar functions


@query
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    return _decomposed(spark, folder).select("IncidntNum", "Year", "Month", "Day", "Hour", "Minute")


@query
def round_hour(spark: SparkSession, folder: str) -> DataFrame:
    rounded = dates.round_hour(F.col("Hour"), F.col("Minute"))
    return _decomposed(spark, folder).select("IncidntNum", rounded.alias("Hour"))


@query
def event_hours(spark: SparkSession, folder: str) -> DataFrame:
    """The hour functions on true timestamps, with both readings of the bands."""
    hour = dates.round_hour(F.hour("ts"), F.minute("ts"))
    return read_table(spark, folder, "events").select(
        "event_id",
        hour.alias("Hour"),
        dates.time_of_day(hour).alias("TimeOfDay"),
        dates.time_of_day(hour, "intended").alias("IntendedTimeOfDay"),
    )


@query
def time_of_day(spark: SparkSession, folder: str) -> DataFrame:
    hour = dates.round_hour(F.col("Hour"), F.col("Minute"))
    return _decomposed(spark, folder).select("IncidntNum", dates.time_of_day(hour).alias("TimeOfDay"))


@query
def season(spark: SparkSession, folder: str) -> DataFrame:
    return _decomposed(spark, folder).select("IncidntNum", dates.season(F.col("Month")).alias("Season"))


@query
def block_or_junction(spark: SparkSession, folder: str) -> DataFrame:
    kind = places.block_or_junction(F.col("Address"))
    return incidents(spark, folder).select("IncidntNum", kind.alias("BlockOrJunc"))


@query
def address_street(spark: SparkSession, folder: str) -> DataFrame:
    street = places.address_street(F.col("Address"))
    return incidents(spark, folder).select("IncidntNum", street.alias("Street"))


@query
def category_rules(spark: SparkSession, folder: str) -> DataFrame:
    refined = categories.refine_category(F.col("Descript"), F.col("Category"))
    return incidents(spark, folder).select("IncidntNum", refined.alias("Category_New"))


@query
def category_rules_on_text(spark: SparkSession, folder: str) -> DataFrame:
    """The keyword rules over whole document texts in capitals."""
    refined = categories.refine_category(F.col("capitals"), F.col("source"))
    documents = read_table(spark, folder, "documents").withColumn("capitals", F.upper("text"))
    return documents.select("doc_id", refined.alias("Category_New"))


@query
def grid_number(spark: SparkSession, folder: str) -> DataFrame:
    cell = places.grid_number(F.col("X"), F.col("Y"))
    return incidents(spark, folder).select("IncidntNum", cell.alias("GridNo"))


@query
def abs_coord(spark: SparkSession, folder: str) -> DataFrame:
    return incidents(spark, folder).select("IncidntNum", F.abs("X").alias("X"))


# Counts


@query
def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.category_counts(_train(spark, folder))


@query
def grid_category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.grid_category_counts(_train(spark, folder))


@query
def grid_category_pivot(spark: SparkSession, folder: str) -> DataFrame:
    train = _train(spark, folder)
    return counts.grid_category_pivot(train, encode.fit_vocabulary(train, LABEL)[LABEL])


@query
def distinct_grids(spark: SparkSession, folder: str) -> DataFrame:
    return counts.distinct_values(_train(spark, folder), "GridNo")


@query
def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.distinct_counts(_train(spark, folder), "GridNo", "Category_New", "PdDistrict", "Location")


@query
def coord_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.non_null_counts(_train(spark, folder), "X")


@query
def column_means(spark: SparkSession, folder: str) -> DataFrame:
    names = ("X", "Y", "Year", "Month", "Hour", "Day", "GridNo", "BlockOrJunc")
    means = counts.column_means(_train(spark, folder), *names)
    return means.select(*(_rounded(name).alias(name) for name in names))


@query
def row_count_check(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder)
    return rows.row_count_check(test, fit_profile(train).attach(test))


# Grid profile


@query
def grid_profile(spark: SparkSession, folder: str) -> DataFrame:
    return fit_profile(_train(spark, folder)).long().withColumn("p", _rounded("p"))


@query
def grid_profile_arrays(spark: SparkSession, folder: str) -> DataFrame:
    quotient = arrays.divide(F.col("counts"), F.col("totals"))
    return _elements(fit_profile(_train(spark, folder)).arrays().withColumn("p", quotient), "p", "GridNo")


@query
def missing_categories(spark: SparkSession, folder: str) -> DataFrame:
    return fit_profile(_train(spark, folder)).missing()


@query
def union_fill(spark: SparkSession, folder: str) -> DataFrame:
    return fit_profile(_train(spark, folder)).filled_counts()


@query
def attach_profile_train(spark: SparkSession, folder: str) -> DataFrame:
    train = _train(spark, folder)
    return _elements(fit_profile(train).attach(train), "ndArray", KEY)


@query
def attach_profile_test(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder)
    return _elements(fit_profile(train).attach(test), "ndArray", KEY)


@query
def profile_string(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors as text, read back to show that the text holds every value."""
    text = fit_profile(_train(spark, folder)).vectors().select("GridNo", arrays.as_text(F.col("p")).alias("ndArray"))
    return _elements(text.withColumn("p", F.from_json("ndArray", "array<double>")), "p", "GridNo")


@query
def array_pad(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the categories a cell has, ascending by name, then zeros."""
    profile = fit_profile(_train(spark, folder))
    present = F.transform(F.array_sort(F.collect_list(F.struct("Category_New", "n"))), lambda pair: pair["n"])
    length = profile.totals().agg(F.count(F.lit(1)).cast("int")).scalar()
    found = profile.counts.groupBy("GridNo").agg(present.alias("found")).withColumn("length", length)
    return _elements(found.withColumn("p", arrays.pad_right(F.col("found"), F.col("length"))), "p", "GridNo")


# Encoders, scalers, density


@query
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder)
    data = one_hot_matrices(train, test)
    return data.test.select(KEY, *data.features)


@query
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder)
    names = ("DayOfWeek", "PdDistrict", "TimeOfDay", "Season", "Category", "Category_New")
    return encode.label_codes(train, test, *names).select(KEY, *names)


@query
def label_encode_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of a column with many values, ranked without a global sort in one task."""
    train, test = _split(spark, folder)
    return encode.label_codes(train, test, "Location").select(KEY, "Location")


@query
def label_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The label as 0/1 columns, one per training class."""
    train, test = _split(spark, folder)
    classes = encode.fit_vocabulary(train, LABEL)
    return encode.one_hot(test.select(KEY, LABEL), classes, {LABEL: "class"})


@query
def schema_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Names and types of the feature table's columns, and how many rows have a value there."""
    features = _features(spark, folder)
    filled = features.agg(F.array(*(F.count(name) for name in features.columns)).alias("n"))
    counted = filled.select(F.posexplode("n").alias("position", "n"))
    return columns.schema_rows(features).join(F.broadcast(counted), "position")


@query
def mean_center(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder)
    names = ("X", "Y", "Hour", "GridNo")
    return encode.mean_center(train, test, *names).select(KEY, *(_rounded(n).alias(n) for n in names))


@query
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder)
    names = ("X", "Y", "Hour", "GridNo")
    return encode.standard_scale(train, test, *names).select(KEY, *(_rounded(n).alias(n) for n in names))


def _label_encoded(spark: SparkSession, folder: str) -> Matrices:
    return label_encoded_matrices(*_split(spark, folder))


def _stored(spark: SparkSession, folder: str, layout: tuple[int, int] = PASSES) -> Matrices:
    return _label_encoded(spark, folder).stored(layout)


@query
def model_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Features and label of the training rows, element by element."""
    data = _label_encoded(spark, folder)
    coded = data.train.withColumn("label", encode.code_of(F.col(LABEL), data.classes))
    assembled = encode.assemble(coded, data.features, KEY, "label")
    values = classifiers.vector_to_array("features").alias("values")
    return _elements(assembled.select(KEY, "label", values), "values", KEY, "label")


def _matrix_rows(spark: SparkSession, folder: str, dropped: tuple[str, ...]) -> DataFrame:
    data = label_encoded_matrices(*_split(spark, folder), dropped=dropped)
    pairs = [F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").cast("double").alias("v")) for n in data.features]
    return data.test.select(KEY, F.inline(F.array(*pairs))).withColumn("v", _rounded("v"))


@query
def model_matrix_reduced(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows of the matrix with the reduced list: every text column coded, the key a feature."""
    return _matrix_rows(spark, folder, columns.NOT_IN_REDUCED)


@query
def model_matrix_summer_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows of the matrix with the list of the log2 forest."""
    return _matrix_rows(spark, folder, columns.NOT_IN_SUMMER_FOREST)


@query
def kde(spark: SparkSession, folder: str) -> DataFrame:
    """Density curves before and after scaling."""
    names = ("DayOfWeek", "Hour", "Month")
    train = materialize(_label_encoded(spark, folder).train.select(*names), "kde-columns")
    scaled = encode.standard_scale(train, train, *names)
    curves = [
        kernel_density(part, *names).withColumn("stage", F.lit(stage))
        for stage, part in (("before", train), ("after", scaled))
    ]
    return curves[0].unionByName(curves[1]).select(
        "stage", "feature", "point", _rounded("x").alias("x"), _rounded("density").alias("density")
    )


# Models and evaluation


def _fit_rows(data: Matrices) -> DataFrame:
    return classifiers.training_rows(data.train, data.features, LABEL, data.classes)


def _predicted(model, data: Matrices) -> DataFrame:
    return classifiers.predict_proba(model, data.test, data.features, data.classes, KEY, LABEL)


def _absolute(data: Matrices) -> Matrices:
    """Longitudes without their sign, for models on non-negative features."""
    positive = {"X": F.abs("X")}
    return Matrices(data.train.withColumns(positive), data.test.withColumns(positive), data.features, data.classes)


def _scaled(data: Matrices) -> Matrices:
    """All features scaled by the training rows."""
    train, test = (encode.standard_scale(data.train, part, *data.features) for part in (data.train, data.test))
    return Matrices(train, test, data.features, data.classes)


@query
def naive_bayes(spark: SparkSession, folder: str) -> DataFrame:
    data = _absolute(_label_encoded(spark, folder))
    return _long(fit_naive_bayes(data.train, data.features, LABEL).predict_proba(data.test, KEY))


@query
def naive_bayes_smoothed_prior(spark: SparkSession, folder: str) -> DataFrame:
    data = _absolute(_stored(spark, folder))
    return _long(_predicted(classifiers.naive_bayes().fit(_fit_rows(data)), data))


@query
def gaussian_bayes(spark: SparkSession, folder: str) -> DataFrame:
    data = _label_encoded(spark, folder)
    return _long(fit_gaussian_bayes(data.train, data.features, LABEL).predict_proba(data.test, KEY))


@query
def log_loss(spark: SparkSession, folder: str) -> DataFrame:
    data = _absolute(_label_encoded(spark, folder))
    predicted = fit_naive_bayes(data.train, data.features, LABEL).predict_proba(data.test, KEY, LABEL)
    return evaluate.score(predicted, LABEL).withColumn("log_loss", _rounded("log_loss"))


@query
def knn_proba(spark: SparkSession, folder: str) -> DataFrame:
    data = _label_encoded(spark, folder)
    return _long(neighbours.knn_proba(data.train, data.test, data.features, LABEL, KEY))


def _forest(data: Matrices) -> StoredForest:
    return fit_forest_in_blocks(_fit_rows(data.for_blocks()))


def _voted(forest: StoredForest, data: Matrices) -> DataFrame:
    return forest.predict_proba(data.test, data.features, data.classes, KEY, LABEL)


@query
def rf_proba(spark: SparkSession, folder: str) -> DataFrame:
    data = _stored(spark, folder, FORESTS)
    return _long(_voted(_forest(data), data))


@query
def rf_proba_log2(spark: SparkSession, folder: str) -> DataFrame:
    """The log2 forest on its own list of features."""
    data = label_encoded_matrices(*_split(spark, folder), dropped=columns.NOT_IN_SUMMER_FOREST).stored(FORESTS)
    forest = classifiers.random_forest(trees=100, depth=11, features="log2")
    return _long(_predicted(forest.fit(_fit_rows(data)), data))


@query
def rf_proba_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    data = one_hot_matrices(*_split(spark, folder)).stored(FORESTS)
    return _long(_voted(_forest(data), data))


@query
def holdout_logloss(spark: SparkSession, folder: str) -> DataFrame:
    data = _stored(spark, folder, FORESTS)
    voted = _voted(_forest(data), data)
    return evaluate.score(voted, LABEL).withColumn("log_loss", _rounded("log_loss"))


def _tree(data: Matrices, **settings) -> ExactTree:
    return fit_exact_tree(data.train, data.features, LABEL, data.classes, **settings)


@query
def dtree_proba(spark: SparkSession, folder: str) -> DataFrame:
    """The established tree: depth 2, leaves of 20 rows, splits of 100, a root's number of features at each node."""
    data = _label_encoded(spark, folder)
    return _long(_tree(data).predict_proba(data.test, KEY))


@query
def dtree_proba_all_features(spark: SparkSession, folder: str) -> DataFrame:
    data = _label_encoded(spark, folder)
    tree = _tree(data, depth=4, min_leaf=5, min_split=2, draw="all")
    return _long(tree.predict_proba(data.test, KEY))


@query
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Importances of the established tree, the one of ``dtree_proba``."""
    importances = _tree(_label_encoded(spark, folder)).importances(spark)
    return importances.withColumn("importance", _rounded("importance"))


@query
def feature_importance_all_features(spark: SparkSession, folder: str) -> DataFrame:
    tree = _tree(_label_encoded(spark, folder), depth=4, min_leaf=5, min_split=2, draw="all")
    return tree.importances(spark).withColumn("importance", _rounded("importance"))


@query
def logreg_proba(spark: SparkSession, folder: str) -> DataFrame:
    data = _stored(spark, folder)
    estimator = classifiers.logistic_regression(data.train.count())
    return _long(_predicted(estimator.fit(_fit_rows(data)), data))


@query
def logreg_proba_l2(spark: SparkSession, folder: str) -> DataFrame:
    """The second established setting: squared penalty, C = 0.6, tolerance 0.001."""
    data = _stored(spark, folder)
    estimator = classifiers.logistic_regression(
        data.train.count(), penalty="l2", inverse_strength=0.6, iterations=100, tolerance=1e-3
    )
    return _long(_predicted(estimator.fit(_fit_rows(data)), data))


def _components(data: Matrices, k: int) -> Components:
    return fit_components(data.train, data.features, k)


def _projected(data: Matrices, k: int, digits: int = DIGITS) -> DataFrame:
    values = F.array(*_components(data, k).values())
    projected = data.test.select(KEY, F.posexplode(values).alias("pos", "p"))
    return projected.withColumn("p", F.round("p", digits))


def _on_components(data: Matrices, k: int, layout: tuple[int, int] = PASSES) -> Matrices:
    """The projections of both parts in place of the features."""
    components = _components(data, k)
    names = [f"component{i}" for i in range(k)]
    columns = [value.alias(name) for value, name in zip(components.values(), names)]
    train, test = (part.select(KEY, LABEL, *columns) for part in (data.train, data.test))
    return Matrices(train, test, names, data.classes).stored(layout)


def _only(data: Matrices, *features: str) -> Matrices:
    """The same rows with fewer features."""
    return Matrices(data.train, data.test, list(features), data.classes)


@query
def pca_project(spark: SparkSession, folder: str) -> DataFrame:
    return _projected(_label_encoded(spark, folder), 6)


@query
def pca_plane(spark: SparkSession, folder: str) -> DataFrame:
    """Both components of the coordinates, which have a closed form; to five places."""
    return _projected(_only(_label_encoded(spark, folder), "X", "Y"), 2, digits=5)


@query
def pca_covariance(spark: SparkSession, folder: str) -> DataFrame:
    """The matrix that the components are taken from."""
    data = _label_encoded(spark, folder)
    matrix = covariance(data.train, data.features)[1]
    cells = [(a, b, float(matrix[i, j])) for i, a in enumerate(data.features) for j, b in enumerate(data.features)]
    return spark.createDataFrame(cells, "a string, b string, v double").withColumn("v", F.round("v", 7))


@query
def pca_variances(spark: SparkSession, folder: str) -> DataFrame:
    """What the test of components can say in closed form: their variances add up to that of the features, they fall,
    and the projections of the training rows have them."""
    data = _label_encoded(spark, folder)
    components = _components(data, len(data.features))
    spread = data.train.agg(*(F.var_samp(value).alias(f"v{i}") for i, value in enumerate(components.values()))).first()
    pairs = list(zip(spread, components.variances))
    same = all(abs(found - own) <= 1e-6 * max(1.0, own) for found, own in pairs)
    falling = all(a >= b for a, b in zip(components.variances, components.variances[1:]))
    row = (len(data.features), float(components.variances.sum()), bool(falling), bool(same))
    schema = "n int, total double, falling boolean, same boolean"
    return spark.createDataFrame([row], schema).withColumn("total", F.round("total", 5))


@query
def svd_project(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows on the first three singular vectors of the training rows, not centred."""
    data = _label_encoded(spark, folder)
    values = F.array(*fit_singular(data.train, data.features, 3).projections())
    return data.test.select(KEY, F.posexplode(values).alias("pos", "p")).withColumn("p", F.round("p", 5))


@query
def svd_energy(spark: SparkSession, folder: str) -> DataFrame:
    """All singular values at once: their squares add up to the squares of all elements."""
    data = _label_encoded(spark, folder)
    values = fit_singular(data.train, data.features, len(data.features)).values
    row = (len(values), float((values**2).sum()), bool((np.diff(values) <= 0).all()))
    found = spark.createDataFrame([row], "n int, squares double, falling boolean")
    return found.withColumn("squares", F.round(F.col("squares") / F.lit(data.train.count()), 5))


@query
def pca_logreg(spark: SparkSession, folder: str) -> DataFrame:
    data = _on_components(_label_encoded(spark, folder), 6)
    estimator = classifiers.logistic_regression(data.train.count(), penalty="l2", iterations=100)
    return _long(_predicted(estimator.fit(_fit_rows(data)), data))


@query
def pca_forest(spark: SparkSession, folder: str) -> DataFrame:
    data = _on_components(_label_encoded(spark, folder), 10, FORESTS)
    forest = classifiers.random_forest(trees=100, depth=13, features="log2")
    return _long(_predicted(forest.fit(_fit_rows(data)), data))


@query
def mlp_proba(spark: SparkSession, folder: str) -> DataFrame:
    scaled = _scaled(_stored(spark, folder)).stored()
    network = classifiers.perceptron(len(scaled.features), len(scaled.classes))
    return _long(_predicted(network.fit(_fit_rows(scaled)), scaled))


@query
def mlp_relu_proba(spark: SparkSession, folder: str) -> DataFrame:
    """The rectified network by Adam over 200 epochs, each a full batch."""
    scaled = _scaled(_stored(spark, folder)).stored()
    network = fit_network(scaled.train, scaled.features, LABEL, KEY, scaled.classes)
    return _long(network.predict_proba(scaled.test, KEY))


@query
def samme_proba(spark: SparkSession, folder: str) -> DataFrame:
    data = _stored(spark, folder)
    model = boosting.fit_boosted_trees(_fit_rows(data), data.classes)
    return _long(model.predict_proba(data.test, data.features, KEY))


@query
def stump_boosting_proba(spark: SparkSession, folder: str) -> DataFrame:
    data = _stored(spark, folder)
    model = boosting.fit_boosted_trees(_fit_rows(data), data.classes, rounds=24, depth=1, rate=1.0)
    return _long(model.predict_proba(data.test, data.features, KEY))


@query
def samme_binary_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """The first rounds of stumps on a single 0/1 feature, which have a closed form."""
    data = _only(_label_encoded(spark, folder), "BlockOrJunc")
    model = boosting.fit_boosted_trees(_fit_rows(data), data.classes, rounds=4, depth=1, rate=1.0)
    voted = [
        (number, *(data.classes[int(c)] for c in one.tree.classes(model.bins(np.array([[0.0], [1.0]])))), one.vote)
        for number, one in enumerate(model.rounds, start=1)
    ]
    schema = "round int, at_junction_0 string, at_junction_1 string, vote double"
    return spark.createDataFrame(voted, schema).withColumn("vote", F.round("vote", 5))


@query
def svm_ovr(spark: SparkSession, folder: str) -> DataFrame:
    scaled = _scaled(_stored(spark, folder)).stored()
    model = kernel_svm.fit_kernel_svm(
        scaled.train, scaled.features, LABEL, scaled.classes, scaled.train.count(), iterations=300
    )
    return _long(model.predict_proba(scaled.test, KEY))


@query
def grid_search(spark: SparkSession, folder: str) -> DataFrame:
    data = _stored(spark, folder, FORESTS)
    return classifiers.grid_search(_fit_rows_in_folds(data, 3))


def _fit_rows_in_folds(data: Matrices, folds: int) -> DataFrame:
    """Training rows with the fold that the key gives them."""
    coded = data.train.withColumn("label", encode.code_of(F.col(LABEL), data.classes).cast("double"))
    return encode.assemble(with_fold(coded, KEY, folds), data.features, "label", "fold")


@query
def cross_validate(spark: SparkSession, folder: str) -> DataFrame:
    """The network on four folds."""
    scaled = _scaled(_stored(spark, folder)).stored()
    network = classifiers.perceptron(len(scaled.features), len(scaled.classes))
    return classifiers.cross_validate(_fit_rows_in_folds(scaled, 4), network)


@query
def cross_validate_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """The same four folds for a model in closed form: rows and rows told right in each."""
    data = _absolute(_label_encoded(spark, folder))

    def predict(train: DataFrame, test: DataFrame) -> DataFrame:
        return fit_naive_bayes(train, data.features, LABEL).predict_proba(test, KEY, LABEL)

    return fold_accuracy(materialize(with_fold(data.train, KEY, 4), "folds"), LABEL, 4, predict)
