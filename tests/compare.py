"""Comparing a Spark result with its SQL, value by value and in any row order."""

from __future__ import annotations

import glob
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        if name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted(repr([row[index] for index in order]) for row in rows)


def spark_rows(df) -> tuple[list[str], list[str]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(con: duckdb.DuckDBPyConnection, text: str) -> tuple[list[str], list[str]]:
    result = con.execute(text)
    columns = [part[0] for part in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())
