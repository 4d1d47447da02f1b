"""Every query against its SQL twin, at the smallest scale unless CHECK_SF_DIR names another."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, TWINS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_twin(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in TWINS:
        problem = differences(df, duck, TWINS[name])
        assert problem in (None, "no rows"), problem
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["branch_id", "miles"] and df.count() > 0
