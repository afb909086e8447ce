"""Registered queries against their DuckDB oracles on the smallest scale factor."""

import pytest

from conftest import SF_SMALL
from jobstar.plans.queries import REGISTRY
from oracle_compare import compare, duck

@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    q = REGISTRY[name]
    problems, rows = compare(q.build(spark, SF_SMALL), con, q.sql)
    assert not problems, problems
    assert rows > 0


def test_every_query_has_a_builder_and_sql():
    assert len(REGISTRY) >= 50
    assert all(q.sql for q in REGISTRY.values())
