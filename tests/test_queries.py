"""Every registered query against its SQL on DuckDB, and every query's schema."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

ORACLES = entry.oracle_sql()
# Fits are exercised in test_model_queries.py too.
COMPARED = sorted(ORACLES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", COMPARED)
def test_matches_sql(spark, sf_dir, duck, name):
    result = compare(entry.queries()[name](spark, sf_dir), duck, ORACLES[name])
    assert result.startswith("ok"), result


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1491
    assert len(df.columns) == 32
