"""Every registered query against its SQL, and the shape of its plan."""

import pytest
from conftest import SF
from oracle import compare, connect

from tallycast.checks import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == []
    else:
        assert df.limit(1).count() == 1


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert not [n for n in QUERIES if n.startswith("op") or "pipeline" in n]


@pytest.mark.parametrize("name", ["daily_change", "acf", "describe", "mann_whitney", "trailing_mean", "lag_matrix", "covid_daily", "sentiment"])
def test_no_window_over_one_partition(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["country_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "In(o_orderpriority, [1-URGENT,5-LOW])" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "o_totalprice" not in plan
