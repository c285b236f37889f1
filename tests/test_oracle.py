from __future__ import annotations

import pytest

from __spark_entry__ import entry
from starloom.registry import ORACLES, QUERIES
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
