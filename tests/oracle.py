"""Compare a Spark result with a DuckDB result: rows, columns, values."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple("~" if x is None else repr(x) for x in row)


def _same(x, y):
    if isinstance(x, float) and isinstance(y, float):
        return x == y
    return x == y


def compare(spark_df, con, sql: str):
    cols = sorted(spark_df.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()]
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows_raw = rel.fetchall()
    assert sorted(dcols) == cols, f"columns differ: spark={cols} sql={sorted(dcols)}"
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    assert len(srows) == len(drows), f"row count spark={len(srows)} sql={len(drows)}"
    srows.sort(key=_key)
    drows.sort(key=_key)
    for a, b in zip(srows, drows):
        assert len(a) == len(b) and all(_same(x, y) for x, y in zip(a, b)), \
            f"first differing row:\n spark={a}\n sql  ={b}"
    return len(srows)
