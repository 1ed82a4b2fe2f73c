"""Every query that has SQL gives the same rows as the SQL does."""

import duckdb
import pytest

from tallspan.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    value = lambda v: None if v is None else str(v) if isinstance(v, str) else f"{float(v):.6f}"
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = df.collect()
    if name not in ORACLE_SQL:
        assert got
        return
    sql = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in sql.description]
    assert sorted(df.columns) == sorted(names)
    assert plain(df.columns, got) == plain(names, sql.fetchall())
