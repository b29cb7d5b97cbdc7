"""Every query of the subpackage that SQL can express, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


def names():
    return sorted(n for n in entry.oracle_sql() if n.startswith("op"))


def test_all_are_registered():
    found = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{k}" for k in range(1, 14)} | {"pipeline"} <= found


@pytest.mark.parametrize("name", names())
def test_query(spark, name):
    con = check.open_tables(SF)
    ok, note = check.compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert ok, note
