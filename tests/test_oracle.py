"""Every registered query on the smallest tables, against its SQL where it has one."""

from __future__ import annotations

import pytest

from tests.compare import difference, duck
from weftline import registry


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(registry.all_queries()))
def test_query(spark, sf, con, name):
    frame = registry.all_queries()[name](spark, sf)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    sql = registry.all_oracles().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        problem, _ = difference(frame, con, sql)
        assert problem is None


def test_oracles_belong_to_queries():
    assert set(registry.all_oracles()) <= set(registry.all_queries())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
