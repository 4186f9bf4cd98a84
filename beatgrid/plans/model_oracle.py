"""SQL counterparts of the model queries that have a closed form or an exact algorithm."""

from __future__ import annotations

import hashlib

from beatgrid.plans.oracle import _BAYES, _FEATURES, _MATRICES, _with

FEATURES = (
    "DayOfWeek", "PdDistrict", "X", "Y", "Month", "Hour", "GridNo", "BlockOrJunc", "season_Summer", "season_Winter",
)
_X = "[x0, x1, x2, x3, x4, x5, x6, x7, x8, x9]"


def _allowed(level: int, draw: int, seed: int) -> str:
    """(node, feature) pairs: at each node, the features with the smallest digests."""
    pairs = []
    for node in range(2**level, 2 ** (level + 1)):
        digests = [(hashlib.md5(f"{seed}/{node}/{name}".encode()).hexdigest(), j) for j, name in enumerate(FEATURES)]
        pairs += [f"({node}, {j})" for _, j in sorted(digests)[:draw]]
    return ", ".join(pairs)


def _level(level: int, min_leaf: int, min_split: int, draw: int, seed: int) -> str:
    """The best split of each node of a level, and the nodes of all rows below it."""
    moved = f"""
  SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node
    ELSE 2 * r.node + CASE WHEN r.x[b.j + 1] <= b.threshold THEN 0 ELSE 1 END END AS node
  FROM ROWS{level} r LEFT JOIN best{level} b ON b.node = r.node"""
    return f""",
size{level} AS (SELECT node, y, count(*) AS t FROM train{level} WHERE node >= {2**level} GROUP BY 1, 2),
able{level} AS (
  SELECT node, CAST(sum(t * t) AS DOUBLE) / sum(t) AS purity FROM size{level}
  GROUP BY 1 HAVING sum(t) >= {min_split} AND count(*) > 1),
choice{level}(node, j) AS (VALUES {_allowed(level, draw, seed)}),
cell{level} AS (
  SELECT r.node, c.j, r.x[c.j + 1] AS v, r.y, count(*) AS n
  FROM train{level} r JOIN able{level} USING (node) JOIN choice{level} c ON c.node = r.node GROUP BY 1, 2, 3, 4),
every{level} AS (
  SELECT p.node, p.j, p.v, s.y, s.t, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT node, j, v FROM cell{level}) p JOIN size{level} s ON s.node = p.node
  LEFT JOIN cell{level} c ON c.node = p.node AND c.j = p.j AND c.v = p.v AND c.y = s.y),
below{level} AS (
  SELECT node, j, v, t, CAST(sum(n) OVER (PARTITION BY node, j, y ORDER BY v) AS BIGINT) AS l FROM every{level}),
side{level} AS (
  SELECT node, j, v, sum(l) AS nl, sum(t - l) AS nr, CAST(sum(l * l) AS DOUBLE) AS sl,
    CAST(sum((t - l) * (t - l)) AS DOUBLE) AS sr
  FROM below{level} GROUP BY 1, 2, 3),
ahead{level} AS (SELECT *, lead(v) OVER (PARTITION BY node, j ORDER BY v) AS following FROM side{level}),
best{level} AS (
  SELECT node, j, threshold, score - purity AS gain FROM (
    SELECT a.node, j, (v + following) / 2 AS threshold, sl / nl + sr / nr AS score, purity,
      row_number() OVER (PARTITION BY a.node ORDER BY sl / nl + sr / nr DESC, j, v) AS place
    FROM ahead{level} a JOIN able{level} USING (node)
    WHERE following IS NOT NULL AND nl >= {min_leaf} AND nr >= {min_leaf})
  WHERE place = 1 AND score - purity > 1e-9),
train{level + 1} AS ({moved.replace("ROWS", "train")}),
test{level + 1} AS ({moved.replace("ROWS", "test")})"""


def _tree(depth: int, min_leaf: int, min_split: int, draw: int, seed: int = 100) -> str:
    start = f""",
train0 AS (SELECT code AS y, {_X} AS x, 1 AS node FROM matrix_train JOIN classes USING (Category_New)),
test0 AS (SELECT PdId, {_X} AS x, 1 AS node FROM matrix_test)"""
    return _MATRICES + start + "".join(_level(level, min_leaf, min_split, draw, seed) for level in range(depth))


def _tree_probabilities(depth: int, *settings: int) -> str:
    return _with(
        _tree(depth, *settings)
        + f""",
leaf AS (SELECT node, y, count(*) AS n FROM train{depth} GROUP BY 1, 2),
full_leaf AS (SELECT node, sum(n) AS n FROM leaf GROUP BY 1)""",
        "SELECT t.PdId, c.Category_New AS class, round(coalesce(l.n, 0) / CAST(f.n AS DOUBLE), 8) AS p "
        f"FROM test{depth} t JOIN full_leaf f USING (node) CROSS JOIN classes c "
        "LEFT JOIN leaf l ON l.node = t.node AND l.y = c.code",
    )


def _tree_importances(depth: int, *settings: int) -> str:
    gains = " UNION ALL ".join(f"SELECT j, gain FROM best{level}" for level in range(depth))
    names = ", ".join(f"({j}, '{name}')" for j, name in enumerate(FEATURES))
    return _with(
        _tree(depth, *settings)
        + f""",
names(j, feature) AS (VALUES {names}),
gains AS ({gains}),
gained AS (SELECT feature, n.j, coalesce(sum(gain), 0) AS gain FROM names n LEFT JOIN gains g ON g.j = n.j GROUP BY 1, 2)""",
        "SELECT CAST(row_number() OVER (ORDER BY gain DESC, j) AS INTEGER) AS rank, feature, "
        "round(gain / (SELECT sum(gain) FROM gained), 8) AS importance FROM gained",
    )


def _samme(rounds: int) -> str:
    """Rounds of stumps on one 0/1 feature: each side votes for its heaviest class."""
    ctes = _MATRICES + """,
weights1 AS (
  SELECT x7 AS v, code, Category_New, CAST(count(*) AS DOUBLE) AS w
  FROM matrix_train JOIN classes USING (Category_New) GROUP BY 1, 2, 3)"""
    for number in range(1, rounds + 1):
        ctes += f""",
vote{number} AS (
  SELECT v, first(code ORDER BY w DESC, code) AS code, first(Category_New ORDER BY w DESC, code) AS class, max(w) AS w
  FROM weights{number} GROUP BY 1),
error{number} AS (SELECT 1 - (SELECT sum(w) FROM vote{number}) / sum(w) AS e, sum(w) AS total FROM weights{number}),
alpha{number} AS (SELECT ln((1 - e) / e) + ln((SELECT count(*) FROM classes) - 1) AS a FROM error{number}),
raised{number} AS (
  SELECT r.v, r.code, Category_New, CASE WHEN r.code = o.code THEN r.w ELSE r.w * exp(a) END AS w
  FROM weights{number} r JOIN vote{number} o ON o.v = r.v CROSS JOIN alpha{number}),
weights{number + 1} AS (
  SELECT v, code, Category_New, w / sum(w) OVER () * (SELECT total FROM error{number}) AS w FROM raised{number})"""
    rows = " UNION ALL ".join(
        f"SELECT {number} AS round, (SELECT class FROM vote{number} WHERE v = 0) AS at_junction_0, "
        f"(SELECT class FROM vote{number} WHERE v = 1) AS at_junction_1, round(a, 5) AS vote FROM alpha{number}"
        for number in range(1, rounds + 1)
    )
    return _with(ctes, rows)


def _bayes_folds(folds: int) -> str:
    """Naive Bayes fitted on the other folds, once per fold."""
    digest = f"CAST('0x' || substr(md5(CAST(PdId AS VARCHAR)), 1, 8) AS BIGINT) % {folds}"
    parts = []
    for fold in range(folds):
        ctes = _BAYES.replace("matrix_train AS (", "all_rows AS (", 1)
        ctes = ctes.replace(
            ",\nlong_train AS (",
            f""",
matrix_train AS (SELECT * FROM all_rows WHERE {digest} <> {fold}),
fold_rows AS (SELECT * FROM all_rows WHERE {digest} = {fold}),
long_train AS (""",
            1,
        )
        ctes = ctes.replace("FROM matrix_test)", "FROM fold_rows)")
        ctes = ctes.replace("FROM train GROUP BY 1)", "FROM matrix_train GROUP BY 1)")
        ctes = ctes.replace("(SELECT count(*) FROM train)", "(SELECT count(*) FROM matrix_train)")
        likeliest = "SELECT PdId, first(class ORDER BY p DESC, class) AS class FROM bayes GROUP BY 1"
        body = (
            f"SELECT {fold} AS fold, count(*) AS n, count(*) FILTER (WHERE l.class = f.Category_New) AS \"right\" "
            f"FROM fold_rows f JOIN ({likeliest}) l USING (PdId)"
        )
        parts.append(f"({_with(ctes, body)})")
    return " UNION ALL ".join(parts)


def _covariance() -> str:
    pairs = ", ".join(f"({i}, {j}, '{a}', '{b}')" for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES))
    return _with(
        _MATRICES + f",\npairs(i, j, a, b) AS (VALUES {pairs}),\nlists AS (SELECT {_X} AS x FROM matrix_train)",
        "SELECT a, b, round(covar_samp(x[i + 1], x[j + 1]), 7) AS v FROM lists CROSS JOIN pairs GROUP BY a, b",
    )


_GAUSSIAN = (
    _MATRICES
    + f""",
long_train AS (
  SELECT Category_New, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS j, unnest({_X}) AS v FROM matrix_train),
long_test AS (SELECT PdId, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS j, unnest({_X}) AS v FROM matrix_test),
centre AS (
  SELECT Category_New, j, CAST(sum(CAST(v AS DECIMAL(28, 10))) AS DOUBLE) / count(*) AS m, count(*) AS n
  FROM long_train GROUP BY 1, 2),
whole AS (SELECT j, CAST(sum(CAST(v AS DECIMAL(28, 10))) AS DOUBLE) / count(*) AS m FROM long_train GROUP BY 1),
widest AS (
  SELECT 1e-9 * max(s) AS raised FROM (
    SELECT j, CAST(sum(CAST((v - m) * (v - m) AS DECIMAL(28, 10))) AS DOUBLE) / count(*) AS s
    FROM long_train JOIN whole USING (j) GROUP BY 1)),
normals AS (
  SELECT Category_New, j, any_value(m) AS m, any_value(n) AS n,
    CAST(sum(CAST((v - m) * (v - m) AS DECIMAL(28, 10))) AS DOUBLE) / count(*) + (SELECT raised FROM widest) AS s
  FROM long_train JOIN centre USING (Category_New, j) GROUP BY 1, 2),
scores AS (
  SELECT PdId, Category_New, sum(-5e-1 * (ln(s * 2 * pi()) + (v - m) * (v - m) / s))
    + ln(any_value(n) / CAST((SELECT count(*) FROM train) AS DOUBLE)) AS score
  FROM long_test JOIN normals USING (j) GROUP BY 1, 2),
shifted AS (SELECT PdId, Category_New, exp(score - max(score) OVER (PARTITION BY PdId)) AS e FROM scores)"""
)

MODEL_ORACLE: dict[str, str] = {
    "gaussian_bayes": _with(
        _GAUSSIAN,
        "SELECT PdId, Category_New AS class, round(e / sum(e) OVER (PARTITION BY PdId), 8) AS p FROM shifted",
    ),
    "svd_energy": _with(
        _MATRICES,
        "SELECT CAST(10 AS INTEGER) AS n, round(("
        + " + ".join(f"sum(x{j} * x{j})" for j in range(10))
        + ") / count(*), 5) AS squares, true AS falling FROM matrix_train",
    ),
    "dtree_proba": _tree_probabilities(2, 20, 100, 3),
    "dtree_proba_all_features": _tree_probabilities(4, 5, 2, 10),
    "feature_importance": _tree_importances(2, 20, 100, 3),
    "feature_importance_all_features": _tree_importances(4, 5, 2, 10),
    "samme_binary_rounds": _samme(4),
    "cross_validate_bayes": _bayes_folds(4),
    "pca_covariance": _covariance(),
    "pca_variances": _with(
        _MATRICES,
        "SELECT CAST(10 AS INTEGER) AS n, round("
        + " + ".join(f"var_samp(x{j})" for j in range(10))
        + ", 5) AS total, true AS falling, true AS same FROM matrix_train",
    ),
    "csv_existing_path": _with(_FEATURES, "SELECT true AS refused, count(*) AS n FROM train"),
}
