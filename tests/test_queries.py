"""The registry's queries against their SQL on the smallest tables."""

import math
from pathlib import Path

import pytest

from treille.plans import queries

DATA = Path("/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.isoformat()[:19] if hasattr(v, "isoformat") else v


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_agrees_with_sql(spark, name):
    import duckdb

    df = queries.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in queries.ORACLE:
        return
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    answer = con.sql(queries.ORACLE[name])
    order = [answer.columns.index(c) for c in columns]
    assert sorted(answer.columns) == columns
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in answer.fetchall()), key=repr)
