import duckdb
import pytest

from utterloom.llm import queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equal(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = queries.queries()[name](spark, DIR)
    cursor = con.execute(queries.oracle_sql()[name])
    want = [dict(zip([c[0] for c in cursor.description], r, strict=True)) for r in cursor.fetchall()]
    assert sorted((r.asDict() for r in df.collect()), key=lambda r: r["doc_id"]) == sorted(want, key=lambda r: r["doc_id"])


def test_every_query_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
