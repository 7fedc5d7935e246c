"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, normal, rows_of

TWINS = oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, duck, folder, name):
    ours = normal(queries()[name](spark, folder).toPandas())
    theirs = normal(duck.execute(TWINS[name]).df())
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0 and rows_of(ours) == rows_of(theirs)


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
