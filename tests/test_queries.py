"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
