"""Run a query on Spark and its SQL on DuckDB and compare whole results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda row: tuple((c is None, str(c)) for c in row))


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), _rows(names, result.fetchall())


def difference(df, con, sql) -> str | None:
    names, got = spark_rows(df)
    wanted_names, wanted = sql_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    different = [(a, b) for a, b in zip(got, wanted) if a != b or
                 [type(x) for x in a if x is not None] != [type(x) for x in b if x is not None]]
    if different:
        return f"{len(different)} rows differ, first {different[0]}"
    return None
