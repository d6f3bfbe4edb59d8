"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def normalise(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), normalise(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), normalise(columns, cursor.fetchall())


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def type_mismatches(df, con, sql: str) -> list[str]:
    wanted = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{name}: {kind} / {wanted.get(name)}"
        for name, kind in df.dtypes
        if KINDS.get(kind, kind) != wanted.get(name)
    ]
