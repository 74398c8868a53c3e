"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF0001
from tools.compare import duck_connect, rows_multiset

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF0001)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF0001)
    srows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert isinstance(srows, list)
        return
    rel = duck.execute(ORACLE[key])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_multiset(df.columns, srows) == rows_multiset(dcols, drows)


def test_entry_runs(spark):
    assert E.entry(spark).count() > 0
