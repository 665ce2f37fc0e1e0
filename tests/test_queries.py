"""Every registered query against its SQL twin on the smallest data."""

import pytest

import __spark_entry__ as entry
from millrace.plans import catalog
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
PYTHON = {"rule_extract", "field_select", "selector_udtf"}  # the only queries with Python in their plans
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "answers" in df.columns


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert ("Python" in plan or "InPandas" in plan) == (name in PYTHON)
    verdict = difference(df, duck, ORACLES[name])
    assert verdict is None, verdict
