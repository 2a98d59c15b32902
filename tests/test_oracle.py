"""Every named query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from cairn.plans.queries import QUERIES
from conftest import SF001, SF01
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import compare, duck  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["n", "k", "parts", "iter", "objective"]
    assert len(rows) == 1 and rows[0].n == 500
    assert SF001 in E.SMOKE_DIR
