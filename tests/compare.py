"""Run a registered query in both engines and compare the rows, whatever their order."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(v)
    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """Empty string if equal, else what differs."""
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    want_cols, want = rel.columns, rel.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    a, b = _canon(got, got_cols), _canon(want, want_cols)
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"{len(a)} vs {len(b)} rows; {sorted(got_cols)}\n spark {only_a[:2]}\n sql   {only_b[:2]}"
