"""Every registered query against its SQL, over the smallest of the given tables."""

import os

import pytest

import __spark_entry__ as entry_points
from eventbase.plans.catalog import QUERIES
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


@pytest.fixture(scope="module")
def sql():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert {q.__name__ for q in QUERIES} <= set(entry_points.queries())
    assert {q.__name__ for q in QUERIES} <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(q.__name__ for q in QUERIES))
def test_query_equals_sql(spark, sql, name):
    got = entry_points.queries()[name](spark, SMALL).toPandas()
    want = sql.execute(entry_points.oracle_sql()[name]).df()
    assert len(want) > 0
    assert difference(got, want) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
