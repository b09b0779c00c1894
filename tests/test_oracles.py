"""Every registered query against its DuckDB twin (small scale; the driver's gate
runs the same comparison at sf0.01 — see tools/check_oracles.py)."""

import pytest

import __spark_entry__ as entry
from skiff.plans import registry
from conftest import SF_SMALL
from oracle_util import compare, duck

ORACLES = registry.ORACLES
QUERIES = registry.QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_listed():
    # queries without an SQL twin are checked by unit tests instead
    assert set(QUERIES) - set(ORACLES) == set()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name](spark, SF_SMALL), ORACLES[name])
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Category", "Total_Sales", "Total_Profit", "Order_Count", "Avg_Profit_Margin_Pct"]
