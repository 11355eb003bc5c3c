"""Compare a registered query with its SQL on DuckDB."""

from __future__ import annotations

import decimal
import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 5) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows(columns: list[str], found) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


def same(spark, query, sql: str, con, sf: str = SF) -> None:
    df = query(spark, sf)
    got = rows(df.columns, df.collect())
    done = con.execute(sql)
    expected = rows([d[0] for d in done.description], done.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    for a, b in zip(*(x[1] for x in (got, expected)), strict=True):
        assert all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-5 * max(1, abs(x))) for x, y in zip(a, b, strict=True)), (a, b)
