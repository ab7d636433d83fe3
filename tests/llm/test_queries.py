"""The queries that have SQL against it, and what is registered."""

import os

import pytest

import __spark_entry__ as entry_points
from eventbase.llm.queries import QUERIES, SQL
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


def test_one_query_per_operator():
    assert [q.__name__.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {q.__name__ for q in QUERIES} | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    got = entry_points.queries()[name](spark, SMALL).toPandas()
    want = connect(SMALL).execute(SQL[name]).df()
    assert len(want) > 0
    assert difference(got, want) is None
