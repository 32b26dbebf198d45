"""Every registered query of the library that has SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from foliospark.plans import registry
from foliospark.session import TABLES

ORACLES = registry.oracles()


def plain(x):
    if x is None or x != x:
        return None
    if isinstance(x, float):
        return float(f"{x:.6g}")
    if isinstance(x, bool | str | int):
        return x
    if isinstance(x, list | tuple):
        return tuple(map(plain, x))
    return str(x)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    df = registry.queries()[name](spark, small)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(columns).collect()), key=repr)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want
