"""Every registered query against its DuckDB oracle SQL (small scale)."""

import pytest

import __spark_entry__ as entry
import oracle_sql
from oracle_compare import compare, duck
from promolens import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle_sql.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    status, detail = compare(got, want)
    assert status != "MISMATCH", detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "GMVE_TA" in df.columns
