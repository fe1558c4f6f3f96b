"""Runs a query in Spark and its twin in DuckDB and compares the rows."""

import glob
import os

import duckdb


def twin(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    return cols, cur.fetchall()


def normal(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


def assert_same(df, sql: str, sf_dir: str):
    cols, rows = twin(sql, sf_dir)
    assert sorted(cols) == sorted(df.columns)
    got, want = normal(df.columns, [tuple(r) for r in df.collect()]), normal(cols, rows)
    assert len(got) == len(want), (len(got), len(want))
    assert got == want, next((g, w) for g, w in zip(got, want) if g != w)
