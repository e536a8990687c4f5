"""Every registered query against its SQL oracle (DuckDB) on the small tables."""
import pytest

from oracle_compare import compare, duckdb_conn
from wardline.plans.oracle import oracle_queries
from wardline.plans.queries import all_queries

QUERIES = all_queries()
ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def con(small_root):
    return duckdb_conn(small_root)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, small_root, name):
    df = QUERIES[name](spark, small_root)
    r = compare(df, con, ORACLE[name])
    assert r["match"], r


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
