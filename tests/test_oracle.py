"""Every registered query with an oracle equals DuckDB at sf0.01; the rest run."""

import os

import pytest

from scorewell.plans.registry import all_oracles, all_queries
from tests.oracle_compare import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
Q = all_queries()
O = all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(O))
def test_matches_oracle(spark, con, name):
    compare(Q[name](spark, SF), con, O[name])


@pytest.mark.parametrize("name", sorted(set(Q) - set(O)))
def test_runs(spark, name):
    df = Q[name](spark, SF)
    assert df.count() >= 0
