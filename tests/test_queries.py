"""Every registered query beside its SQL, on the smallest tables.

Not only the last plan of a query is looked at: a listener keeps those of all
that it ran, staged frames and their reads included.
"""

import time

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def _plans_since(spark, last):
    """(id, physical plan) of the executions with larger ids than ``last``, newest first.

    Waits until all of them have ended and have a plan.
    """
    until = time.monotonic() + 60
    while True:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        known = spark._jsparkSession.sharedState().statusStore().executionsList()
        found, missing = [], []
        for i in reversed(range(known.size())):
            execution = known.apply(i)
            if execution.executionId() <= last:
                break
            plan = execution.physicalPlanDescription()
            if plan is None or execution.completionTime().isEmpty():
                missing.append(execution.executionId())
            else:
                found.append((execution.executionId(), plan))
        if not missing:
            return found
        assert time.monotonic() < until, f"executions without an end or a plan: {missing}"
        time.sleep(0.2)


def _last_execution(spark):
    known = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max((known.apply(i).executionId() for i in range(known.size())[-50:]), default=-1)


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection, name):
    last = _last_execution(spark)
    result = queries()[name](spark, FOLDER).toPandas()
    plans = _plans_since(spark, last)
    assert plans
    for _, plan in plans:
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert len(result) > 0
    if name in oracle_sql():
        assert not differences(result, connection.execute(oracle_sql()[name]).df())


def test_entry(spark):
    profile = entry(spark)
    assert profile.columns[0] == "RFM_level" and profile.count() == 4
