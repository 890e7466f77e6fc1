"""Every registered query against its DuckDB twin (the driver's check), on
the smoke data; the full correctness scale (sf0.01) runs with
PAYMART_TWIN_SF=/root/testdata/sf0.01."""

import os

import pytest

import __spark_entry__ as entry
from paymart.oracle import load_all as load_oracle
from paymart.plans.catalog import load_all as load_queries
from twin import compare, duck

SF = os.environ.get("PAYMART_TWIN_SF", "/root/testdata/sf0.001")
QUERIES = load_queries()
ORACLE = load_oracle()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert r["spark_cols"] == r["duck_cols"]
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "fraud_rate_pct" in df.columns
