"""Run a registered query and its DuckDB oracle on the same tables and
compare row count, column names and the sorted multiset of rows."""

from __future__ import annotations

import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and v != v:
        return None
    if isinstance(v, bool):
        return v
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, out


def compare(spark, con, entry_mod, name: str, sf_dir: str):
    df = entry_mod.queries()[name](spark, sf_dir)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(entry_mod.oracle_sql()[name])
    d_cols, d_rows = rows_of([c[0] for c in rel.description], rel.fetchall())
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns spark={s_cols} duckdb={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duckdb={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)
