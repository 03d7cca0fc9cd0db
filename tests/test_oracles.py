"""Every query with an SQL equivalent against DuckDB, on the smallest tables."""

import duckdb
import pytest

import utterloom.catalog as catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return str(x)
    if isinstance(x, (list, tuple)):
        return str([plain(y) for y in x])
    return repr(round(float(x), 6) + 0.0)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(plain(v[k]) for k in order) for v in values)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equal(spark, duck, name):
    df = catalog.queries()[name](spark, DIR)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(catalog.oracle_sql()[name])
    want = rows([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(catalog.queries().keys() - catalog.oracle_sql().keys()))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, DIR).count() > 0
