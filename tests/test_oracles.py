"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as E
from arrivals.plans import checks, oracle
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

NAMES = sorted(checks.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["arr_state", "year", "month", "arrivals"]
    assert df.count() > 0
