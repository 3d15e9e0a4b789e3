"""Every registered query equals its DuckDB oracle (exact values, any row order)."""

import pytest

import __spark_entry__ as entry
from fleetstar.oracle import ORACLE
from fleetstar.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.parity import compare, duck

NAMES = sorted(ORACLE)  # the library's own; the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert "error" not in r, r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns[0] == "store_id"
