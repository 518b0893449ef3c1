"""Every registered query against its SQL oracle (DuckDB) on the smallest data."""

import pytest

import __spark_entry__ as E
from roadlens.plans.registry import ORACLE
from roadlens.plans.registry import QUERIES as REGISTERED
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(REGISTERED)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(REGISTERED) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF, [name], con=con, verbose=False)[name]
    assert res[0] == "OK", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["idate", "sum_users_total", "sum_users_affected"]
    assert df.count() >= 0
