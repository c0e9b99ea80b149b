"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import difference

import __spark_entry__ as entry_points
from corpusflow.checks import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert difference(spark, FOLDER, QUERIES[name], ORACLES[name]) is None
