"""Every query agrees with its SQL, and none is planned as a cross join."""

import os

import pytest

from checks.compare import check, connect
from checks.oracles import ORACLE
from checks.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")

@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees(spark, con, name):
    problem = check(spark, con, name, SF)  # an empty result is a problem too
    assert problem is None, problem


@pytest.mark.parametrize("name", ["m02_route_pathfinding", "m04_customer_segmentation", "m07_receivables_aging",
                                  "m08_transit_anomalies", "m10_data_quality", "m12_network_exposure",
                                  "d12_headline_facts", "p23_asof_timestamps", "p61_previous_event"])
def test_no_nested_loops(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
