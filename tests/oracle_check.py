"""Compare named queries with their SQL counterparts: python tests/oracle_check.py [folder] [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def normal(rows: list[tuple], names: list[str]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(row[i] for i in order) for row in rows]
    table.sort(key=lambda row: tuple((value is None, str(type(value)), value if value is not None else 0) for value in row))
    return [names[i] for i in order], table


def difference(spark_rows, spark_names, sql_rows, sql_names) -> str:
    """Empty where the two results hold the same rows."""
    left_names, left = normal(spark_rows, spark_names)
    right_names, right = normal(sql_rows, sql_names)
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, abs_tol=1e-9))
            if not same or type(x) is not type(y):
                return f"{a} / {b}"
    return ""


def check(spark: SparkSession, connection, folder: str, name: str) -> tuple[str, int, float, float]:
    start = time.time()
    df = __spark_entry__.queries()[name](spark, folder)
    rows = [tuple(row) for row in df.collect()]
    middle = time.time()
    sql = __spark_entry__.oracle_sql().get(name)
    if sql is None:
        return "", len(rows), middle - start, 0.0
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    problem = difference(rows, df.columns, result.fetchall(), names)
    return problem, len(rows), middle - start, time.time() - middle


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in sys.argv[2:] or __spark_entry__.queries():
        try:
            problem, rows, spark_seconds, sql_seconds = check(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            continue
        kind = "rows" if name not in __spark_entry__.oracle_sql() else "DIFF" if problem else "same"
        print(f"{kind} {name} rows={rows} spark={spark_seconds:.1f}s sql={sql_seconds:.1f}s {problem[:600]}", flush=True)


if __name__ == "__main__":
    main()
