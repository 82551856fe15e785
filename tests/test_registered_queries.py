"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

from check import compare, connect
from tierworks.plans.catalog import REGISTRY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, FOLDER, REGISTRY[name]) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
