"""Every registered query agrees with its DuckDB text on the smallest tables."""

import os

import pytest

from checks.compare import compare, duck
from checks.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    state, note, _, _ = compare(spark, con, SF, name)
    assert state == ("OK" if name in ORACLE else "ROWS"), note


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
