"""Order-insensitive comparison of a Spark result with DuckDB SQL."""

from __future__ import annotations

import glob
import os

import duckdb

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, list):
        return tuple(value)
    return value


def _sorted_rows(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    cols = sorted(df.columns)
    spark_rows = _sorted_rows(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return [f"columns: spark {cols}, sql {sorted(rel.columns)}"]
    sql_types = dict(zip(rel.columns, map(str, rel.types)))
    problems = []
    for name, kind in df.dtypes:
        if kind in TYPES and sql_types[name] != TYPES[kind]:
            problems.append(f"type of {name}: spark {kind}, sql {sql_types[name]}")
    duck_rows = _sorted_rows(rel.select(*[f'"{c}"' for c in cols]).fetchall())
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows: spark {len(spark_rows)}, sql {len(duck_rows)}")
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first:\n   {bad[0][0]}\n   {bad[0][1]}")
    return problems
