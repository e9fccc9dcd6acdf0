"""Compare a Spark result with the result of its SQL in DuckDB, types included."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
    "INTEGER[]": "array<int>",
}
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(folder, name)}.parquet')")
    return con


def _plain(value):
    if value is None:
        return "~null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        if math.isnan(value):
            return "nan"
        return f"{value:.6f}" if value else "0.000000"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both agree, otherwise a short description."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in expected.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    actual = dict(df.dtypes)
    wrong = {n: (actual[n], kinds[n]) for n in names if actual[n] != kinds[n]}
    if wrong:
        return f"types (spark, sql): {wrong}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(names, expected.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(names)}: first different row {g} instead of {w}"
    return None
