"""Every registered query against its SQL on the smallest tables, and what plans may not hold."""

from __future__ import annotations

import os

import pytest
from check import compare, duck

from catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
BANNED = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BANNED if b in plan]
    if name in ORACLES:
        ok, message = compare(df, con, ORACLES[name])
        assert ok, message
    else:
        assert df.columns and df.count() >= 0
