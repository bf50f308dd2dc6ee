"""Every registered query against its SQL."""

import pytest
from compare import differences, duck
from conftest import plan

import __spark_entry__ as entry

#: The queries whose operator is a Python function of one value.
ROW_AT_A_TIME = {"ud_01_scalar_udf", "ud_02_registered_udf"}

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    found = differences(df, con, SQL[name])
    text = plan(df)
    assert "CartesianProduct" not in text
    assert "BatchEvalPython" not in text or name in ROW_AT_A_TIME
    assert [d for d in found if d != "no rows"] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
