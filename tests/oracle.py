"""Compare a registered query with its SQL on DuckDB, as the outside check does."""

import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    values = [tuple(norm(r[i]) for i in order) for r in rows]
    return names, sorted(values, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(spark_df, con, sql):
    """None if equal, else a text that says what differs."""
    got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    want = table([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} <> {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} <> {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} <> {b}"
    return None
