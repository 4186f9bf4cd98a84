"""Every query that has SQL gives the same rows; the others give complete probabilities or scores."""

from __future__ import annotations

import pytest
from oracle_check import connect, difference

import __spark_entry__

QUERIES, ORACLE = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_contract(spark):
    assert set(ORACLE) <= set(QUERIES)
    result = __spark_entry__.entry(spark)
    assert result.columns == ["Category_New", "Season", "n"] and result.count() > 0


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, connection, folder, name):
    df = QUERIES[name](spark, folder)
    result = connection.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert difference([tuple(r) for r in df.collect()], df.columns, result.fetchall(), names) == ""


@pytest.mark.parametrize("name", [n for n in ORACLE if n not in ("rows_to_json", "csv_roundtrip", "csv_dropmalformed")])
def test_plan_has_no_all_pairs_join(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
