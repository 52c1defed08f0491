"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from evalspark.plans import registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def rows(columns, found):
    plain = lambda v: round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in found)


@pytest.mark.parametrize("name", sorted(registered.ORACLE_SQL))
def test_same_as_sql(spark, sql, name):
    df = registered.QUERIES[name](spark, SF)
    want = sql.execute(registered.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, want.fetchall())
