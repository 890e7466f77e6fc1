"""Registered training-data queries that have DuckDB twins."""

import pytest

from paymart.llm.registry import load_oracle_sql, load_queries
from twin import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(load_oracle_sql()))
def test_twin(spark, name):
    r = compare(load_queries()[name](spark, SF), duck(SF), load_oracle_sql()[name])
    assert r["spark_cols"] == r["duck_cols"]
    assert r["match"], r


def test_every_operator_is_registered():
    names = load_queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
