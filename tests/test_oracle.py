"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""
import pytest

from conftest import SF_SMALL
from ledgerwatch.plans import catalog
from oracle_compare import compare, duck

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    if name not in catalog.ORACLE:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, catalog.ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
