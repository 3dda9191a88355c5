"""Run one query on Spark and its SQL on DuckDB and compare names, row counts and values."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time(0) else value
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    table = df.toArrow()
    return as_rows(df.columns, zip(*[c.to_pylist() for c in table.columns])) if table.num_columns else ([], Counter())


def sql_rows(con, sql):
    cur = con.execute(sql)
    return as_rows([d[0] for d in cur.description], cur.fetchall())


def differences(df, con, sql, show: int = 4) -> str:
    """Empty text when both sides agree."""
    names_a, a = spark_rows(df)
    names_b, b = sql_rows(con, sql)
    if names_a != names_b:
        return f"columns differ: {names_a} / {names_b}"
    if a == b:
        return ""
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    key = lambda r: tuple((x is None, str(x)) for x in r)
    only_a, only_b = sorted(only_a, key=key), sorted(only_b, key=key)
    lines = [f"rows {sum(a.values())} / {sum(b.values())}, only spark {len(only_a)}, only sql {len(only_b)}", str(names_a)]
    for x, y in list(zip(only_a, only_b))[:show]:
        lines.append("diff: " + ", ".join(f"{n}: {p!r} / {q!r}" for n, p, q in zip(names_a, x, y) if p != q))
    lines += [f"spark: {r}" for r in only_a[:show]] + [f"sql:   {r}" for r in only_b[:show]]
    return "\n".join(lines)
