"""Every registered query with SQL must give DuckDB's rows; the others must run."""

from __future__ import annotations

import pytest
from compare import differences, duck

from brightwater import plans

QUERIES, ORACLES = plans.all_queries(), plans.all_oracles()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, connection, name):
    assert differences(spark, connection, QUERIES[name], ORACLES[name], sf_dir) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert frame.columns
    assert frame.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
