"""Every registered query against its SQL check, exactly, on the smallest sample; no plan crosses rows or
leaves the JVM."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from martloom.plans.registry import oracle_sql, queries
from tests.check_results import checker, differences
from tests.samples import plan

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return checker(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, FOLDER)
    text = plan(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "Pandas", "RDD"):
        assert operator not in text
    assert differences(df, con, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
