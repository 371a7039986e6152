"""Every query with an SQL counterpart must equal it exactly."""

import os

import pytest

from checks import compare, oracle
from hazgrid import catalog

SF = os.environ.get("ORACLE_SF", "0.01")
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    from conftest import TESTDATA

    return compare.connect(f"{TESTDATA}/sf{SF}")


def test_every_sql_has_a_query():
    assert set(SQL) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    from conftest import TESTDATA

    df = catalog.queries()[name](spark, f"{TESTDATA}/sf{SF}")
    assert compare.difference(df, duck, SQL[name]) is None
