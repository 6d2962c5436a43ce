"""Every key with an oracle agrees with DuckDB on the smallest shared tables;
every key without one runs and returns rows."""

import pytest

import __spark_entry__ as E
from tessera.plans.compare import compare, duckdb_views
from tests.conftest import SF_SMALL

ORACLES = E.oracle_sql()
NO_ORACLE = sorted(set(E.queries()) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, con, key):
    res = compare(E.queries()[key](spark, SF_SMALL), con, ORACLES[key])
    assert res["ok"], res


@pytest.mark.parametrize("key", NO_ORACLE)
def test_model_keys_run(spark, key):
    assert E.queries()[key](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "n"] and 0 < df.count() <= 5


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())
