"""Holds a query's rows against its SQL in DuckDB: same columns, same rows in any order."""

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def shown(v) -> str:
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return str(v)


def rows(values: list[tuple]) -> list[tuple]:
    return sorted(tuple(map(shown, r)) for r in values)


def same(df, con, sql: str) -> None:
    columns = sorted(df.columns)
    found = rows([tuple(r) for r in df.select(*columns).collect()])
    result = con.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({sql})").fetchall()
    assert sorted(c[0] for c in con.execute(f"DESCRIBE {sql}").fetchall()) == columns
    assert found == rows(result)
