"""Every registered query against its SQL counterpart, over whole tables."""

from __future__ import annotations

from functools import cache

import pytest
from compare import difference, duck

import __spark_entry__ as entry_points
from lapseflow.plans import registry

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.fixture(scope="module", autouse=True)
def shared_inputs():
    """Let the queries share one staged listing; each stages its own otherwise."""
    own = registry.Inputs
    registry.Inputs = cache(own)
    yield
    registry.Inputs = own


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, con, folder, key):
    assert difference(QUERIES[key](spark, folder), con, ORACLES[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql(spark, folder, key):
    assert QUERIES[key](spark, folder).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_is_a_dataframe(spark):
    assert entry_points.entry(spark).columns[:3] == ["id", "name", "tld"]
