"""SQL counterparts of the named queries, written independently of the column functions."""

from __future__ import annotations

_FEATURE_COLUMNS = (
    "IncidntNum, Category, DayOfWeek, PdDistrict, X, Y, Location, PdId, Year, Month, Hour, Day, "
    "Category_New, GridNo, BlockOrJunc, TimeOfDay, Season"
)

_RAW = """
raw AS (
  SELECT o_orderkey AS IncidntNum,
    (['NON-CRIMINAL', 'RECOVERED VEHICLE', 'SECONDARY CODES', 'LARCENY/THEFT', 'WARRANTS', 'VANDALISM',
      'FAMILY OFFENSES', 'SEX OFFENSES, FORCIBLE', 'BAD CHECKS', 'TREA', 'SUSPICIOUS OCC', 'WEAPON LAWS',
      'ROBBERY'])[1 + o_orderkey % 13] AS Category,
    (['GRAND THEFT FROM LOCKED AUTO', 'DRIVING UNDER THE INFLUENCE OF ALCOHOL', 'POSSESSION OF BURGLARY TOOLS',
      'INDECENT EXPOSURE', 'DOMESTIC VIOLENCE', 'HARASSING PHONE CALLS',
      'UNDER INFLUENCE OF ALCOHOL IN A PUBLIC PLACE', 'CREDIT CARD, FRAUD', 'POSSESSION OF DRUG PARAPHERNALIA',
      'LOST PROPERTY', 'SEXUAL BATTERY'])[1 + (o_orderkey * 7 + o_custkey) % 11] AS Descript,
    dayname(o_orderdate) AS DayOfWeek,
    strftime(o_orderdate, '%m/%d/%Y') AS "Date",
    lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST((o_orderkey * 7) % 60 AS VARCHAR), 2, '0')
      AS "Time",
    (['BAYVIEW', 'CENTRAL', 'INGLESIDE', 'MISSION', 'NORTHERN', 'PARK', 'RICHMOND', 'SOUTHERN', 'TARAVAL',
      'TENDERLOIN'])[1 + o_custkey % 10] AS PdDistrict,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderstatus END AS Resolution,
    CASE WHEN o_orderkey % 3 = 0 THEN '18TH ST / VALENCIA ST' ELSE '300 Block of OAK ST' END AS Address,
    CASE WHEN o_orderkey % 41 = 0 THEN -1205e-1 ELSE -1230137e-4 + (o_custkey % 101) * 65e-4 END AS X,
    CASE WHEN o_orderkey % 61 = 0 THEN NULL
         WHEN o_orderkey % 37 = 0 AND year(o_orderdate) > 1998 THEN 379e-1
         ELSE 376040e-4 + (o_orderkey % 97) * 23e-4 END AS Y,
    '(' || CAST(o_orderkey % 97 AS VARCHAR) || ', ' || CAST(o_custkey % 101 AS VARCHAR) || ')' AS Location,
    o_orderkey * 100000 + o_custkey AS PdId
  FROM orders)"""

_DATED = (
    _RAW
    + """,
dated AS (
  SELECT raw.*,
    CAST(year(strptime("Date", '%m/%d/%Y')) AS INTEGER) AS Year,
    CAST(month(strptime("Date", '%m/%d/%Y')) AS INTEGER) AS Month,
    CAST(day(strptime("Date", '%m/%d/%Y')) AS INTEGER) AS Day,
    CAST(split_part("Time", ':', 1) AS INTEGER) AS RawHour,
    CAST(split_part("Time", ':', 2) AS INTEGER) AS Minute,
    CAST(CASE WHEN CAST(split_part("Time", ':', 2) AS INTEGER) > 40
              THEN (CAST(split_part("Time", ':', 1) AS INTEGER) + 1) % 24
              ELSE CAST(split_part("Time", ':', 1) AS INTEGER) % 24 END AS INTEGER) AS Hour
  FROM raw)"""
)


def _rules(text: str, category: str) -> str:
    return f"""CASE
      WHEN contains({text}, 'LICENSE') OR contains({text}, 'TRAFFIC') OR contains({text}, 'SPEEDING')
        OR contains({text}, 'DRIVING') THEN 'TRAFFIC VIOLATION'
      WHEN contains({text}, 'BURGLARY TOOLS') OR contains({text}, 'AIR GUN') OR contains({text}, 'TEAR GAS')
        OR contains({text}, 'WEAPON') OR contains({category}, 'WEAPON LAWS') THEN 'DEADLY TOOL POSSESSION'
      WHEN contains({text}, 'SEX') OR contains({category}, 'SEX OFFENSES') THEN 'SEXUAL OFFENSES'
      WHEN contains({text}, 'FORGERY') OR contains({text}, 'FRAUD') OR contains({category}, 'BAD CHECKS')
        OR contains({category}, 'COUNTERFEITING') OR contains({category}, 'EMBEZZLEMENT')
        THEN 'FRAUD/COUNTERFEITING'
      WHEN contains({text}, 'TOBACCO') OR contains({text}, 'DRUG') THEN 'DRUG/NARCOTIC'
      WHEN contains({text}, 'INDECENT EXPOSURE') OR contains({text}, 'OBSCENE')
        OR contains({text}, 'DISORDERLY CONDUCT') THEN 'PORNOGRAPHY/OBSCENE MAT'
      WHEN contains({text}, 'DOMESTIC VIOLENCE') THEN 'DOMESTIC VIOLENCE'
      WHEN contains({category}, 'SUSPICIOUS OCC') THEN 'SUSPICIOUS PERSON/ACT'
      WHEN contains({category}, 'TREA') THEN 'LOITERING'
      WHEN contains({category}, 'WARRANTS') THEN 'WARRANT ISSUED'
      WHEN contains({category}, 'VANDALISM') THEN 'ARSON'
      WHEN contains({text}, 'HARASSING') OR contains({category}, 'FAMILY OFFENSES') THEN 'ASSAULT'
      WHEN contains({text}, 'INFLUENCE OF ALCOHOL') THEN 'DRUKENNESS'
      ELSE {category} END"""


def _band(hour: str) -> str:
    return f"""CASE WHEN {hour} IN (0, 1, 2) THEN 'After Midnight' WHEN {hour} IN (4, 5, 6, 7) THEN 'Dawn'
      WHEN {hour} >= 11 THEN 'Morning' ELSE 'Night' END"""


_SEASON = """CASE WHEN Month IN (12, 1, 2) THEN 'Winter' WHEN Month IN (3, 4, 5) THEN 'Spring'
      WHEN Month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"""

_GRID = """CAST(20 * floor((Y - 376040e-4) / ((378324e-4 - 376040e-4) / 20))
      + floor((X - (-1230137e-4)) / ((-1223549e-4 - (-1230137e-4)) / 20)) AS BIGINT)"""

_DERIVED = (
    _DATED
    + f""",
derived AS (
  SELECT IncidntNum, Category, DayOfWeek, PdDistrict, X, Y, Location, PdId, Year, Month, Hour, Day,
    {_rules("Descript", "Category")} AS Category_New,
    {_GRID} AS GridNo,
    CAST(contains(Address, '/') AS INTEGER) AS BlockOrJunc,
    {_band("Hour")} AS TimeOfDay,
    {_SEASON} AS Season
  FROM dated)"""
)

_FEATURES = (
    _DERIVED
    + """,
features AS (
  SELECT * FROM derived
  WHERE Category NOT IN ('NON-CRIMINAL', 'RECOVERED VEHICLE', 'SECONDARY CODES')
    AND X < -1223549e-4 AND Y IS NOT NULL),
train AS (SELECT * FROM features WHERE Year <= 1998),
test AS (SELECT * FROM features WHERE Year > 1998)"""
)

_PROFILE = (
    _FEATURES
    + """,
totals AS (SELECT Category_New, count(*) AS total FROM train GROUP BY 1),
cells AS (SELECT GridNo, Category_New, count(*) AS n FROM train GROUP BY 1, 2),
dense AS (
  SELECT g.GridNo, t.Category_New, coalesce(c.n, 0) AS n, t.total,
    CAST(coalesce(c.n, 0) AS DOUBLE) / t.total AS p,
    CAST(row_number() OVER (PARTITION BY g.GridNo ORDER BY t.Category_New) - 1 AS INTEGER) AS pos
  FROM (SELECT DISTINCT GridNo FROM train) g CROSS JOIN totals t
  LEFT JOIN cells c ON c.GridNo = g.GridNo AND c.Category_New = t.Category_New)"""
)

_VOCABULARY = (
    _FEATURES
    + """,
districts AS (SELECT PdDistrict, dense_rank() OVER (ORDER BY PdDistrict) - 1 AS code
              FROM (SELECT DISTINCT PdDistrict FROM train)),
weekdays AS (SELECT DayOfWeek, dense_rank() OVER (ORDER BY DayOfWeek) - 1 AS code
             FROM (SELECT DISTINCT DayOfWeek FROM train)),
classes AS (SELECT Category_New, dense_rank() OVER (ORDER BY Category_New) - 1 AS code
            FROM (SELECT DISTINCT Category_New FROM train))"""
)


def _matrix(part: str) -> str:
    return f"""SELECT PdId, Category_New,
    CAST(coalesce(w.code, (SELECT count(*) FROM weekdays)) AS DOUBLE) AS x0,
    CAST(coalesce(d.code, (SELECT count(*) FROM districts)) AS DOUBLE) AS x1,
    X AS x2, Y AS x3, CAST(Month AS DOUBLE) AS x4, CAST(Hour AS DOUBLE) AS x5, CAST(GridNo AS DOUBLE) AS x6,
    CAST(BlockOrJunc AS DOUBLE) AS x7,
    CASE WHEN Season = 'Summer' THEN 1e0 ELSE 0e0 END AS x8, CASE WHEN Season = 'Winter' THEN 1e0 ELSE 0e0 END AS x9
  FROM {part} LEFT JOIN weekdays w USING (DayOfWeek) LEFT JOIN districts d USING (PdDistrict)"""


_MATRICES = (
    _VOCABULARY
    + f""",
matrix_train AS ({_matrix("train")}),
matrix_test AS ({_matrix("test")})"""
)

_BAYES = (
    _MATRICES
    + """,
long_train AS (
  SELECT Category_New, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS j,
    unnest([x0, x1, abs(x2), x3, x4, x5, x6, x7, x8, x9]) AS v FROM matrix_train),
long_test AS (
  SELECT PdId, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS j,
    unnest([x0, x1, abs(x2), x3, x4, x5, x6, x7, x8, x9]) AS v FROM matrix_test),
sums AS (SELECT Category_New, j, CAST(sum(CAST(v AS DECIMAL(28, 10))) AS DOUBLE) AS s
         FROM long_train GROUP BY 1, 2),
shares AS (SELECT Category_New, j, ln((s + 1e-2) / (sum(s) OVER (PARTITION BY Category_New) + 1e-1)) AS w FROM sums),
priors AS (SELECT Category_New, PRIOR AS w FROM train GROUP BY 1),
scores AS (
  SELECT t.PdId, s.Category_New, sum(t.v * s.w) + any_value(p.w) AS score
  FROM long_test t JOIN shares s USING (j) JOIN priors p ON p.Category_New = s.Category_New GROUP BY 1, 2),
shifted AS (SELECT PdId, Category_New, exp(score - max(score) OVER (PARTITION BY PdId)) AS e FROM scores),
bayes AS (SELECT PdId, Category_New AS class, e / sum(e) OVER (PARTITION BY PdId) AS p FROM shifted)"""
)

_SMOOTHED_BAYES = _BAYES.replace(
    "PRIOR", "ln((count(*) + 1e-2) / ((SELECT count(*) FROM train) + 1e-2 * (SELECT count(*) FROM classes)))"
)
_BAYES = _BAYES.replace("PRIOR", "ln(count(*) / CAST((SELECT count(*) FROM train) AS DOUBLE))")

_SQUARED = " + ".join(f"(q.x{j} - t.x{j}) * (q.x{j} - t.x{j})" for j in range(10))


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def _one_hot() -> str:
    """Columns named after the values of the derived records."""
    seasons = ("Fall", "Spring", "Summer", "Winter")
    districts = (
        "BAYVIEW", "CENTRAL", "INGLESIDE", "MISSION", "NORTHERN", "PARK", "RICHMOND", "SOUTHERN", "TARAVAL",
        "TENDERLOIN",
    )
    weekdays = ("Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday")
    flags = [
        f"CAST({column} = '{value}' AS INTEGER) AS \"{prefix}_{value}\""
        for column, prefix, values in (
            ("Season", "season", seasons),
            ("PdDistrict", "pdDist", districts),
            ("DayOfWeek", "day", weekdays),
        )
        for value in values
    ]
    return f"SELECT PdId, X, Y, Year, Month, Hour, GridNo, BlockOrJunc, {', '.join(flags)} FROM test"


def _pivot() -> str:
    names = (
        "ARSON", "ASSAULT", "DEADLY TOOL POSSESSION", "DOMESTIC VIOLENCE", "DRUG/NARCOTIC", "DRUKENNESS",
        "FRAUD/COUNTERFEITING", "LARCENY/THEFT", "LOITERING", "PORNOGRAPHY/OBSCENE MAT", "ROBBERY",
        "SEXUAL OFFENSES", "SUSPICIOUS PERSON/ACT", "TRAFFIC VIOLATION", "WARRANT ISSUED",
    )
    cells = [f"count(*) FILTER (WHERE Category_New = '{name}') AS \"{name}\"" for name in names]
    return f"SELECT GridNo, {', '.join(cells)} FROM train GROUP BY GridNo"


def _codes(*names: str) -> str:
    ranks = [
        f"(SELECT c.code FROM (SELECT {n} AS v, dense_rank() OVER (ORDER BY {n}) - 1 AS code "
        f"FROM (SELECT DISTINCT {n} FROM train)) c WHERE c.v = test.{n}) AS {n}"
        for n in names
    ]
    return f"SELECT PdId, {', '.join(ranks)} FROM test"


def _curves() -> str:
    pieces = []
    for stage in ("before", "after"):
        for name in ("x0", "x4", "x5"):
            feature = {"x0": "DayOfWeek", "x4": "Month", "x5": "Hour"}[name]
            value = name
            if stage == "after":
                value = (
                    f"({name} - {_mean(name, 'matrix_train')}) / {_deviation(name, 'matrix_train')}"
                )
            pieces.append(f"SELECT '{stage}' AS stage, '{feature}' AS feature, {value} AS v FROM matrix_train")
    return " UNION ALL ".join(pieces)


def _mean(column: str, table: str = "train") -> str:
    """Mean from an exact sum."""
    return f"(SELECT CAST(sum(CAST({column} AS DECIMAL(28, 10))) AS DOUBLE) / count({column}) FROM {table})"


def _deviation(column: str, table: str = "train") -> str:
    rough = f"(SELECT round(avg({column}), 3) FROM {table})"
    away = f"(SELECT {column} - {rough} AS d FROM {table})"
    return f"sqrt({_mean('d * d', away)} - {_mean('d', away)} * {_mean('d', away)})"


def _matrix_rows(numbers: tuple[str, ...], seasons: tuple[str, ...]) -> str:
    """(PdId, feature, v) of test rows, every text column coded."""
    texts = ("Category", "DayOfWeek", "PdDistrict", "Location", "TimeOfDay")
    ctes, joins = [], []
    for name in texts:
        ctes.append(
            f"code_{name} AS (SELECT {name}, dense_rank() OVER (ORDER BY {name}) - 1 AS code "
            f"FROM (SELECT DISTINCT {name} FROM train))"
        )
        joins.append(f"LEFT JOIN code_{name} ON code_{name}.{name} = test.{name}")
    values = [f"coalesce(code_{n}.code, (SELECT count(*) FROM code_{n}))" for n in texts]
    values += [f"test.{n}" for n in numbers] + ["test.PdId"]
    values += [f"CASE WHEN Season = '{n}' THEN 1 ELSE 0 END" for n in seasons]
    names = [*texts, *numbers, "PdId_feature", *(f"season_{n}" for n in seasons)]
    return (
        f"WITH {_FEATURES.strip()},\n{', '.join(ctes)}\n"
        f"SELECT test.PdId, unnest([{', '.join(repr(n) for n in names)}]) AS feature, "
        f"round(unnest([{', '.join(f'CAST({v} AS DOUBLE)' for v in values)}]), 8) AS v FROM test {' '.join(joins)}"
    )


def _label_flags() -> str:
    names = (
        "ARSON", "ASSAULT", "DEADLY TOOL POSSESSION", "DOMESTIC VIOLENCE", "DRUG/NARCOTIC", "DRUKENNESS",
        "FRAUD/COUNTERFEITING", "LARCENY/THEFT", "LOITERING", "PORNOGRAPHY/OBSCENE MAT", "ROBBERY",
        "SEXUAL OFFENSES", "SUSPICIOUS PERSON/ACT", "TRAFFIC VIOLATION", "WARRANT ISSUED",
    )
    return ", ".join(f"CAST(Category_New = '{n}' AS INTEGER) AS \"class_{n}\"" for n in names)


_TYPES = (
    "bigint string string string double double string bigint int int int int string bigint int string string"
).split()

_PLANE = (
    _FEATURES
    + f""",
centre AS (SELECT {_mean("X")} AS mx, {_mean("Y")} AS my),
spread AS (SELECT sum((X - mx) * (X - mx)) AS a, sum((X - mx) * (Y - my)) AS b, sum((Y - my) * (Y - my)) AS c
           FROM train CROSS JOIN centre),
root AS (SELECT a, b, c, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l FROM spread),
axis AS (SELECT b / sqrt(b * b + (l - a) * (l - a)) AS u, (l - a) / sqrt(b * b + (l - a) * (l - a)) AS v FROM root),
axes AS (SELECT CASE WHEN (CASE WHEN abs(u) >= abs(v) THEN u ELSE v END) < 0 THEN -u ELSE u END AS u1,
                CASE WHEN (CASE WHEN abs(u) >= abs(v) THEN u ELSE v END) < 0 THEN -v ELSE v END AS v1 FROM axis),
turned AS (SELECT u1, v1, CASE WHEN (CASE WHEN abs(v1) >= abs(u1) THEN -v1 ELSE u1 END) < 0 THEN v1 ELSE -v1 END AS u2,
                  CASE WHEN (CASE WHEN abs(v1) >= abs(u1) THEN -v1 ELSE u1 END) < 0 THEN -u1 ELSE u1 END AS v2
           FROM axes)"""
)

_LOCATIONS = (
    _FEATURES
    + """,
locations AS (SELECT Location, dense_rank() OVER (ORDER BY Location) - 1 AS code
              FROM (SELECT DISTINCT Location FROM train))"""
)

_KDE = (
    _MATRICES
    + f""",
samples AS ({_curves()}),
weights AS (SELECT stage, feature, v, count(*) AS n FROM samples GROUP BY 1, 2, 3),
widths AS (SELECT stage, feature, count(*) AS n, stddev_samp(v) * pow(count(*), -2e-1) AS h,
             min(v) AS low, max(v) AS high FROM samples GROUP BY 1, 2),
points AS (SELECT stage, feature, n, h, CAST(i AS INTEGER) AS point,
             (low - 3 * h) + i * ((high - low + 6 * h) / 99) AS x
           FROM widths CROSS JOIN range(0, 100) r(i))"""
)

ORACLE: dict[str, str] = {
    "csv_roundtrip": _with(_FEATURES, f"SELECT {_FEATURE_COLUMNS} FROM features"),
    "csv_dropmalformed": _with(_RAW, "SELECT * FROM raw WHERE IncidntNum % 31 <> 0 AND IncidntNum % 29 <> 0"),
    "rows_to_json": _with(
        _FEATURES, f"SELECT CAST(to_json(f) AS VARCHAR) AS value FROM (SELECT {_FEATURE_COLUMNS} FROM features) f"
    ),
    "preview_limit": _with(_FEATURES, f"SELECT {_FEATURE_COLUMNS} FROM train ORDER BY PdId LIMIT 5"),
    "feature_table": _with(_FEATURES, f"SELECT {_FEATURE_COLUMNS} FROM features"),
    "category_by_season": _with(_FEATURES, "SELECT Category_New, Season, count(*) AS n FROM features GROUP BY 1, 2"),
    "drop_columns": _with(
        _FEATURES, "SELECT DayOfWeek, PdDistrict, X, Y, Month, Hour, GridNo, BlockOrJunc, Season FROM train"
    ),
    "drop_columns_reduced": _with(
        _FEATURES,
        "SELECT Category, DayOfWeek, PdDistrict, Y, Location, PdId, Month, Hour, Day, GridNo, BlockOrJunc, "
        "TimeOfDay, Season FROM train",
    ),
    "struct_expand": _with(_FEATURES, f"SELECT {_FEATURE_COLUMNS} FROM train"),
    "exclude_categories": _with(
        _RAW,
        "SELECT IncidntNum, Category FROM raw "
        "WHERE Category NOT IN ('NON-CRIMINAL', 'RECOVERED VEHICLE', 'SECONDARY CODES')",
    ),
    "bbox_filter": _with(_RAW, "SELECT IncidntNum, X FROM raw WHERE X < -1223549e-4"),
    "temporal_split": _with(
        _DATED, "SELECT IncidntNum, Year, CASE WHEN Year <= 1998 THEN 'train' ELSE 'test' END AS split FROM dated"
    ),
    "drop_null_rows": _with(
        _DERIVED, "SELECT PdId, Category_New, GridNo, Y FROM derived WHERE Y IS NOT NULL AND X IS NOT NULL"
    ),
    "select_by_type": _with(
        _FEATURES,
        "SELECT Category, DayOfWeek, PdDistrict, Location, Category_New, TimeOfDay, Season, IncidntNum, X, Y, PdId, "
        "Year, Month, Hour, Day, GridNo, BlockOrJunc FROM train",
    ),
    "date_parts": _with(_DATED, "SELECT IncidntNum, Year, Month, Day, RawHour AS Hour, Minute FROM dated"),
    "round_hour": _with(_DATED, "SELECT IncidntNum, Hour FROM dated"),
    "event_hours": f"""
WITH h AS (SELECT event_id, CAST(CASE WHEN minute(ts) > 40 THEN (hour(ts) + 1) % 24 ELSE hour(ts) END AS INTEGER)
             AS Hour FROM events)
SELECT event_id, Hour, {_band("Hour")} AS TimeOfDay,
  CASE WHEN Hour <= 2 THEN 'After Midnight' WHEN Hour <= 7 THEN 'Dawn' WHEN Hour <= 11 THEN 'Morning'
    WHEN Hour <= 16 THEN 'Afternoon' WHEN Hour <= 20 THEN 'Evening' ELSE 'Night' END AS IntendedTimeOfDay
FROM h""",
    "time_of_day": _with(_DATED, f"SELECT IncidntNum, {_band('Hour')} AS TimeOfDay FROM dated"),
    "season": _with(_DATED, f"SELECT IncidntNum, {_SEASON} AS Season FROM dated"),
    "block_or_junction": _with(
        _RAW, "SELECT IncidntNum, CAST(contains(Address, '/') AS INTEGER) AS BlockOrJunc FROM raw"
    ),
    "address_street": _with(
        _RAW,
        "SELECT IncidntNum, CASE WHEN contains(Address, '/') THEN split_part(Address, '/', 1) "
        "ELSE split_part(Address, 'Block of', 2) END AS Street FROM raw",
    ),
    "category_rules": _with(_RAW, f"SELECT IncidntNum, {_rules('Descript', 'Category')} AS Category_New FROM raw"),
    "category_rules_on_text": f"SELECT doc_id, {_rules('upper(text)', 'source')} AS Category_New FROM documents",
    "grid_number": _with(_RAW, f"SELECT IncidntNum, {_GRID} AS GridNo FROM raw"),
    "abs_coord": _with(_RAW, "SELECT IncidntNum, abs(X) AS X FROM raw"),
    "category_counts": _with(_FEATURES, "SELECT Category_New, count(*) AS n FROM train GROUP BY 1"),
    "grid_category_counts": _with(_FEATURES, "SELECT GridNo, Category_New, count(*) AS n FROM train GROUP BY 1, 2"),
    "grid_category_pivot": _with(_FEATURES, _pivot()),
    "distinct_grids": _with(_FEATURES, "SELECT DISTINCT GridNo FROM train"),
    "distinct_counts": _with(
        _FEATURES,
        "SELECT count(DISTINCT GridNo) AS GridNo, count(DISTINCT Category_New) AS Category_New, "
        "count(DISTINCT PdDistrict) AS PdDistrict, count(DISTINCT Location) AS Location FROM train",
    ),
    "coord_counts": _with(_FEATURES, "SELECT X, count(X) AS n FROM train GROUP BY X"),
    "column_means": _with(
        _FEATURES,
        "SELECT "
        + ", ".join(
            f"round({_mean(c)}, 8) AS {c}" for c in ("X", "Y", "Year", "Month", "Hour", "Day", "GridNo", "BlockOrJunc")
        ),
    ),
    "row_count_check": _with(
        _FEATURES, "SELECT count(*) AS n_left, count(*) AS n_right, TRUE AS ok FROM test"
    ),
    "grid_profile": _with(_PROFILE, "SELECT GridNo, Category_New, round(p, 8) AS p FROM dense"),
    "grid_profile_arrays": _with(_PROFILE, "SELECT GridNo, pos, round(p, 8) AS p FROM dense"),
    "missing_categories": _with(_PROFILE, "SELECT GridNo, Category_New FROM dense WHERE n = 0"),
    "union_fill": _with(_PROFILE, "SELECT GridNo, Category_New, CAST(n AS DOUBLE) AS n FROM dense"),
    "attach_profile_train": _with(
        _PROFILE, "SELECT PdId, pos, round(p, 8) AS p FROM train JOIN dense USING (GridNo)"
    ),
    "attach_profile_test": _with(
        _PROFILE,
        "SELECT PdId, k.pos, round(coalesce(p, 0), 8) AS p FROM test "
        "CROSS JOIN (SELECT CAST(row_number() OVER (ORDER BY Category_New) - 1 AS INTEGER) AS pos FROM totals) k "
        "LEFT JOIN dense d ON d.GridNo = test.GridNo AND d.pos = k.pos",
    ),
    "profile_string": _with(_PROFILE, "SELECT GridNo, pos, round(p, 8) AS p FROM dense"),
    "array_pad": _with(
        _PROFILE,
        "SELECT GridNo, CAST(row_number() OVER (PARTITION BY GridNo ORDER BY n = 0, Category_New) - 1 AS INTEGER) "
        "AS pos, CAST(n AS DOUBLE) AS p FROM dense",
    ),
    "one_hot": _with(_FEATURES, _one_hot()),
    "label_encode": _with(
        _FEATURES, _codes("DayOfWeek", "PdDistrict", "TimeOfDay", "Season", "Category", "Category_New")
    ),
    "label_encode_wide": _with(
        _LOCATIONS, "SELECT PdId, code AS Location FROM test LEFT JOIN locations USING (Location)"
    ),
    "mean_center": _with(
        _FEATURES,
        "SELECT PdId, "
        + ", ".join(f"round({c} - {_mean(c)}, 8) AS {c}" for c in ("X", "Y", "Hour", "GridNo"))
        + " FROM test",
    ),
    "standard_scale": _with(
        _FEATURES,
        "SELECT PdId, "
        + ", ".join(
            f"round(({c} - {_mean(c)}) / {_deviation(c)}, 8) AS {c}"
            for c in ("X", "Y", "Hour", "GridNo")
        )
        + " FROM test",
    ),
    "model_matrix": _with(
        _MATRICES,
        "SELECT PdId, code AS label, CAST(unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS INTEGER) AS pos, "
        "round(unnest([x0, x1, x2, x3, x4, x5, x6, x7, x8, x9]), 8) AS p "
        "FROM matrix_train JOIN classes USING (Category_New)",
    ),
    "kde": _with(
        _KDE,
        "SELECT p.stage, p.feature, p.point, round(any_value(p.x), 8) AS x, "
        "round(sum(w.n * exp(-5e-1 * ((p.x - w.v) / p.h) * ((p.x - w.v) / p.h))) "
        "/ (any_value(p.n) * any_value(p.h) * sqrt(2 * pi())), 8) AS density "
        "FROM points p JOIN weights w ON w.stage = p.stage AND w.feature = p.feature GROUP BY 1, 2, 3",
    ),
    "naive_bayes": _with(_BAYES, "SELECT PdId, class, round(p, 8) AS p FROM bayes"),
    "naive_bayes_smoothed_prior": _with(_SMOOTHED_BAYES, "SELECT PdId, class, round(p, 8) AS p FROM bayes"),
    "label_one_hot": _with(_FEATURES, f"SELECT PdId, {_label_flags()} FROM test"),
    "schema_rows": _with(
        _FEATURES,
        "SELECT CAST(p AS INTEGER) AS position, name, type, (SELECT count(*) FROM features) AS n FROM (VALUES "
        + ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(zip(_FEATURE_COLUMNS.split(", "), _TYPES)))
        + ") AS v(p, name, type)",
    ),
    "model_matrix_reduced": _matrix_rows(
        ("Y", "Month", "Hour", "Day", "GridNo", "BlockOrJunc"), ("Summer", "Winter")
    ),
    "model_matrix_summer_forest": _matrix_rows(
        ("IncidntNum", "Y", "Month", "Hour", "Day", "GridNo", "BlockOrJunc"), ("Fall", "Summer")
    ),
    "pca_plane": _with(
        _PLANE,
        "SELECT PdId, CAST(unnest([0, 1]) AS INTEGER) AS pos, "
        "round(unnest([(X - mx) * u1 + (Y - my) * v1, (X - mx) * u2 + (Y - my) * v2]), 5) AS p "
        "FROM test CROSS JOIN centre CROSS JOIN turned",
    ),
    "log_loss": _with(
        _BAYES,
        "SELECT round(CAST(sum(CAST(-ln(least(greatest(coalesce(b.p, 0), 1e-15), 1 - 1e-15)) AS DECIMAL(28, 10))) "
        "AS DOUBLE) / count(*), 8) AS log_loss, count(*) AS n FROM matrix_test t LEFT JOIN bayes b ON b.PdId = t.PdId AND b.class = t.Category_New",
    ),
    "knn_proba": _with(
        _MATRICES
        + f""",
nearest AS (
  SELECT q.PdId, unnest(min({{'d': {_SQUARED}, 'c': t.Category_New}}, 1000)) AS t
  FROM matrix_test q CROSS JOIN matrix_train t GROUP BY q.PdId),
votes AS (SELECT PdId, t.c AS class, count(*) AS n FROM nearest GROUP BY 1, 2),
voters AS (SELECT least(1000, count(*)) AS k FROM train)""",
        "SELECT q.PdId, c.Category_New AS class, round(coalesce(v.n, 0) / CAST(k AS DOUBLE), 8) AS p "
        "FROM matrix_test q CROSS JOIN classes c CROSS JOIN voters "
        "LEFT JOIN votes v ON v.PdId = q.PdId AND v.class = c.Category_New",
    ),
}
