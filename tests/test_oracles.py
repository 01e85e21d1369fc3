"""Every named query against its SQL in DuckDB, on the smallest test data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_module  # noqa: E402
from check_oracles import difference, oracle_connection  # noqa: E402
from retinue.catalog import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

WITHOUT_ORACLE = set()


@pytest.fixture(scope="module")
def duck():
    con = oracle_connection(FOLDER)
    yield con
    con.close()


def test_every_query_but_the_undefined_ones_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_ORACLE
    assert entry_module.queries().keys() >= QUERIES.keys()
    assert entry_module.oracle_sql().items() >= ORACLES.items()


def test_entry_gives_the_feature_table(spark):
    df = entry_module.entry(spark)
    assert len(df.columns) == 18 and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert forbidden not in plan
    assert difference(duck, df, name) is None
