"""Every registered query against its DuckDB oracle (sf0.001), plus the
driver contract of __spark_entry__."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, rows  # noqa: E402

from places import SF_SMALL  # noqa: E402

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_contract(spark):
    assert set(ORACLE) <= set(QUERIES)
    df = E.entry(spark)
    assert df.count() > 0
    assert "o_mid" in df.columns


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in ORACLE:
        assert got is not None
        return
    want = con.execute(ORACLE[name]).fetchdf()
    c1, r1 = rows(got)
    c2, r2 = rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
