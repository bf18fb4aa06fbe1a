"""Every registered query against its DuckDB oracle (order-insensitive)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

from skywarden.plans import catalog  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert rows_of(df.columns, s_rows, True) == rows_of(o_cols, o_rows, True)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "indicator" in df.columns
