"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.conftest import plan_of
from tests.oracle_check import compare, connect
from tillmart.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sample_dir):
    return connect(sample_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, sample_dir, name):
    message = compare(duck, spark, name, QUERIES[name], sample_dir)
    assert message == "", message


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream_", "sink_", "dedup_", "raw_months"))])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, sample_dir, name):
    plan = plan_of(QUERIES[name].run(spark, sample_dir))
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
