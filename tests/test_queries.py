"""Every registered query of the library's own operators against its SQL; the rest run and keep a stable schema."""

import pytest

from tagloom.plans.queries import ORACLES, QUERIES
from tests.compare import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    same(QUERIES[name](spark, SF), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    a = QUERIES[name](spark, SF)
    assert a.columns and a.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
