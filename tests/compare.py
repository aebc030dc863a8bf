"""Runs a query and its SQL and compares the rows, whatever their order."""

import decimal
from pathlib import Path

import duckdb


def norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


def both(spark, queries, sql, name, sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = queries[name](spark, sf)
    cols = sorted(df.columns)
    got = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
    out = con.sql(sql[name])
    assert sorted(out.columns) == cols
    at = [out.columns.index(c) for c in cols]
    want = [tuple(norm(r[i]) for i in at) for r in out.fetchall()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(got, key=key), sorted(want, key=key)
