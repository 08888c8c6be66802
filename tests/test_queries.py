"""Every query of the library against its SQL, over the smallest tables."""

import pytest

import __spark_entry__ as entry
import oracle
from workload import catalogue

QUERIES, SQL = catalogue.QUERIES, catalogue.ORACLES


@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    if name in SQL:
        assert oracle.compare(spark, duck, QUERIES[name], SQL[name], small) is None
    else:
        assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "metadata" in df.columns
