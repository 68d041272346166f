"""Run a registered query and its SQL twin over one data folder and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _sorted_rows([d[0] for d in result.description], result.fetchall())


def differences(df, con, sql) -> list[str]:
    got_columns, got = spark_rows(df)
    want_columns, want = sql_rows(con, sql)
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    problems = []
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    problems += [f"{a} != {b}" for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return problems
