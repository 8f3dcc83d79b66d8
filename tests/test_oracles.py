"""Every registered query equals its DuckDB oracle (row count, columns, values) on sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SMALL
from leadflow.plans import catalog
from oracle import compare, type_mismatches

catalog.load_all()
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_driver_contract_lists_them_all():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "installs" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, key):
    df = QUERIES[key](spark, SMALL)
    ok, msg = compare(df, duck_small, ORACLES[key])
    assert ok, f"{key}: {msg}"
    assert type_mismatches(df, duck_small, ORACLES[key]) == []


@pytest.mark.parametrize("key", ["final_assemble", "settlement", "csp_funnel", "efficiency", "route_screen"])
def test_headline_matches_oracle_mid(spark, duck_mid, key):
    from conftest import MID
    ok, msg = compare(QUERIES[key](spark, MID), duck_mid, ORACLES[key])
    assert ok, f"{key}: {msg}"
