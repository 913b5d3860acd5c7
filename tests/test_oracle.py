"""Every registered query against its DuckDB oracle (order-insensitive)."""

import pytest

from conftest import SF_ORACLE
from insight.plans.registry import load_all
from oracle_harness import compare, duck

PLANS, SQLS = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, PLANS[name], SQLS[name], SF_ORACLE, con)
    assert r["ok"], r.get("why")
    assert not r["types"], r["types"]
