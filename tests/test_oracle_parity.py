"""Every registered query against its independent DuckDB SQL (sf0.001)."""

import pytest

import __spark_entry__ as E
from priceloom.plans import registry
from check_oracle import compare, duck

from conftest import SF_SMALL

ORACLE = E.oracle_sql()
NAMES = sorted(registry.catalogue())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(ORACLE[name]).df()
    assert compare(got, want) == "OK"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_share_pct" in df.columns
