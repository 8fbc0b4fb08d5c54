"""Every query equals its SQL on the same tables, without Python workers or cross joins."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entries
from ledgerlake.plans.sample_oracles import ORACLES
from ledgerlake.plans.sample_queries import QUERIES
from tests.conftest import SMOKE
from tests.oracle import connect, differences


UNWANTED = re.compile("ArrowEvalPython|BatchEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def connection():
    return connect(SMOKE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entries.queries()) and set(ORACLES) <= set(entries.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    frame = QUERIES[name](spark, SMOKE)
    assert not UNWANTED.search(frame._jdf.queryExecution().executedPlan().toString())
    assert differences(frame, connection, ORACLES[name]) is None


def test_entry_returns_rows(spark):
    assert not entries.entry(spark).isEmpty()
