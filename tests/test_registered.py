"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

import __spark_entry__ as registered  # noqa: E402

SF = "/root/testdata/sf0.001"
OWN = sorted(name for group in registered._GROUPS for name in group.QUERIES)


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(OWN) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, name, SF)
    assert ok, note
