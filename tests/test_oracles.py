"""Every query with SQL gives what DuckDB gives for that SQL on the smallest tables."""

import datetime
import glob
import os

import pytest

from vellumflow.plans import catalog


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    yield con
    con.close()


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(x):
        if isinstance(x, bool) or x is None or isinstance(x, str):
            return x
        if isinstance(x, datetime.datetime):
            return x.replace(tzinfo=None).isoformat()
        return round(float(x), 9)

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    if not os.path.isdir(sf):
        pytest.skip("no tables here")
    df = catalog.queries()[name](spark, sf)
    cur = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(cur.fetchall(), columns)
