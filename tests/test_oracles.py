"""Every registered query against its DuckDB oracle on the smallest tables (sf0.001)."""

import pytest

from strideframe.plans.catalog import all_queries
from strideframe.plans.oracle_check import duck, rows_of

QUERIES = sorted(n for n, q in all_queries().items() if q.sql is not None)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, sf_small, name):
    q = all_queries()[name]
    sdf = q.run(spark, sf_small)
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(q.oracle())
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(d_names)
    assert rows_of(sdf.columns, s_rows) == rows_of(d_names, d_rows)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
