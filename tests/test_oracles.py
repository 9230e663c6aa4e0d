"""Every core query against its SQL, and the ones without SQL for rows and a stable schema."""

import importlib

import pytest
from oracle import connect, differences

import __spark_entry__ as entry

for module in entry.PLANS:
    importlib.import_module(module)
from spotlake.plans import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, sf, name):
    assert differences(spark, con, sf, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_twice_alike(spark, sf, name):
    first, again = QUERIES[name](spark, sf), QUERIES[name](spark, sf)
    assert first.schema == again.schema
    assert sorted(map(repr, first.collect())) == sorted(map(repr, again.collect()))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
