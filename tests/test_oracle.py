"""Every registered query against its DuckDB oracle (driver-style compare)."""

import pytest

from candlewick.plans import catalog
from candlewick.plans.oracle_check import compare, duckdb_connection

catalog.load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    if name not in catalog.ORACLES:
        assert df.count() >= 0
        return
    res = compare(df, con, catalog.ORACLES[name])
    assert res["match"], res


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
