"""Spark query against check SQL, row by row."""

import decimal
import math


def _value(v):
    if isinstance(v, decimal.Decimal):
        v = int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=repr)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in (
        "region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations"
    ).split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def check(spark, con, sf_dir, fn, sql):
    """None if equal, else a short text on the first difference."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        diff = [(g, w) for g, w in zip(got[1], want[1]) if g != w][:2]
        return f"{len(got[1])} rows != {len(want[1])} rows: {diff}"
    return None
