"""Every named query against its check SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.open_tables(SF)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


def names():
    """Queries of this part; optional parts test theirs."""
    return sorted(n for n, f in entry.queries().items() if f.__module__.startswith("webloom.plans"))


@pytest.mark.parametrize("name", names())
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, note
