"""Driver contract: entry smoke check and every query vs its DuckDB oracle."""

import pytest
from conftest import SF_SMALL
from oracle_harness import compare, duck

import __spark_entry__ as E
from tripmart.plans.queries import QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["weekday", "pickup_hour", "trips"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, E.queries()[name], E.oracle_sql()[name], con)
    assert r["status"] == "match", r
