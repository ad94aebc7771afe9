"""The tables as one SQLite file, for tools that expect it."""

from __future__ import annotations

import sqlite3
from datetime import date, datetime
from decimal import Decimal
from itertools import islice

from pyspark.sql import DataFrame

BATCH = 1000


def _plain(value):
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return str(value) if isinstance(value, Decimal) else value


def export(tables: dict[str, DataFrame], path: str) -> None:
    """Write the tables, partition by partition, in one transaction; tables of these names are replaced."""
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL"}
    with sqlite3.connect(path) as con:
        con.execute("PRAGMA journal_mode=WAL")
        for name, frame in tables.items():
            columns = ", ".join(f'"{c}" {kinds.get(kind, "TEXT")}' for c, kind in frame.dtypes)
            con.execute(f'DROP TABLE IF EXISTS "{name}"')
            con.execute(f'CREATE TABLE "{name}" ({columns})')
            rows = (tuple(map(_plain, r)) for r in frame.toLocalIterator())
            while batch := list(islice(rows, BATCH)):
                con.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(frame.columns))})', batch)
    con.close()
