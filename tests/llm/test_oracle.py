"""Queries with SQL equal DuckDB over the whole table."""

import pytest

from scorewell.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
