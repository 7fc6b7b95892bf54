"""Every query of the layered library against its SQL on the smallest tables.

The training-data queries have tests of their own.
"""

import compare
import pytest

import __spark_entry__ as entry_module
from workload.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "NestedLoop"):
        assert unwanted not in plan
    assert compare.differences(df, con, entry_module.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).count() > 0
