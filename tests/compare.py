"""Compare query results with the SQL that states them."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """In-process SQL over all tables of a folder."""
    base = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return base


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells)


def differences(frame, base: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Readable differences; empty when columns, rows and values agree."""
    found = normal(frame.columns, [tuple(row) for row in frame.collect()])
    relation = base.sql(sql)
    wanted = normal(relation.columns, relation.fetchall())
    if found[0] != wanted[0]:
        return [f"columns {found[0]} instead of {wanted[0]}"]
    if len(found[1]) != len(wanted[1]):
        return [f"{len(found[1])} rows instead of {len(wanted[1])}"]
    unequal = [(a, b) for a, b in zip(found[1], wanted[1]) if a != b]
    return [f"{len(unequal)} rows differ, e.g. {a} instead of {b}" for a, b in unequal[:1]]
