"""Every registered query against its SQL twin; those without one must give rows."""

import pytest
from oracle import connect, differences

from usertide.catalog import ORACLES, QUERIES

# Operators no query with a SQL twin may need.
NOT_NATIVE = ("CartesianProduct", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [x for x in NOT_NATIVE if x in plan] == []
    assert differences(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_comparison_notices_a_wrong_value(spark, con, sf_dir):
    df = QUERIES["cohort_sizes"](spark, sf_dir)
    changed = df.withColumn("cohort_size", df.cohort_size + 1)
    assert differences(changed, con, ORACLES["cohort_sizes"])


def test_entry_gives_rows(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
