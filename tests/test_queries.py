"""Every registered query equals its independent DuckDB formulation."""

import pytest

import __spark_entry__ as entry
from conftest import SF_MID, SF_SMALL
from starloom.operators.entries import OPERATOR_QUERIES
from starloom.oracle.check import compare
from starloom.plans import MODELS

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
NAMES = sorted([*MODELS, *OPERATOR_QUERIES])


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(QUERIES) and set(NAMES) <= set(ORACLE)


def test_all_models_registered():
    assert len(MODELS) == 103 and set(MODELS) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, duck_small, name):
    ok, msg, _ = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert ok, msg


@pytest.mark.parametrize("name", ["q01", "q05", "q14a", "q17", "q23b", "q47", "q51", "q64", "q67", "q72",
                                  "q75", "q78", "q95", "r38_r40_top_customers_per_nation"])
def test_query_matches_oracle_mid(spark, duck_mid, name):
    ok, msg, n = compare(QUERIES[name](spark, SF_MID), duck_mid, ORACLE[name])
    assert ok, msg
