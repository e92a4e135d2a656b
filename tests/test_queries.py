"""Every query against its SQL equivalent on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare
from workload.oracle import ORACLE
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert compare(spark, FOLDER, name).startswith("ok")
