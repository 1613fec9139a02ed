"""Every query with oracle SQL must match DuckDB on sf0.01 (the driver's gate)."""

import pytest

from conftest import SF01
import __spark_entry__ as E
from oracle_compare import compare, duck

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, con, key):
    r = compare(spark, SF01, key, E.queries()[key], E.oracle_sql()[key], con)
    assert r["status"] == "OK", r
