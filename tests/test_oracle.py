"""Every SQL-checkable registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from cinerank.plans import catalog
from oracle_check import digest, duck

D = "/root/testdata/sf0.001"
SQL = {k: v for k, v in E.oracle_sql().items() if k in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(D)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, D)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_is_registered_with_oracle_or_listed():
    assert set(catalog.QUERIES) == set(SQL) | set(E.NON_SQL) and set(catalog.QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["genres", "rank", "mid", "score"]
    assert df.count() > 0
