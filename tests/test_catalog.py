"""Every registered core query runs, and agrees with its SQL on the smallest tables."""

import os

import duckdb
import pytest

from cellspark import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("nation", "supplier", "customer", "part", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple("" if r[i] is None else str(r[i]) for i in order) for r in data])


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = db.execute(catalog.ORACLES[name])
    want = rows([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description) and got == want


def test_entry_points():
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
