"""Every registered query runs; those with an SQL twin give the same rows (sf0.001)."""

import pytest

import __spark_entry__ as entry
from compare import compare, engine

FOLDER = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return engine(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_sql(spark, duck, name):
    assert compare(spark, duck, FOLDER, name) == ""


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in ORACLE))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLE) <= set(entry.queries())
