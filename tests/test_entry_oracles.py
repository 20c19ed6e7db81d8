"""Every registered query against its DuckDB oracle (sf0.001), plus the entry smoke test."""

import pytest

import __spark_entry__ as E
from conftest import SF0001
from oracle import compare, duck

QUERIES = E._QUERIES  # those of the training-data operators have tests of their own
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 8
    assert df.columns == ["attribution_model", "channel", "attribution_percent"]


def test_every_query_has_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF0001)
    if name in ORACLES:
        ok, msg = compare(df, ORACLES[name], con)
        assert ok, msg
    else:
        assert df.count() > 0
    spark.catalog.clearCache()
