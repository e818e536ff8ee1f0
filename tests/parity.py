"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def kind(dtype: str) -> str:
    """Type families that a value comparison must agree on."""
    families = {
        "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int", "hugeint": "int",
        "double": "float", "float": "float", "string": "text", "varchar": "text",
    }
    return families.get(dtype.lower(), dtype.lower())


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    clean = [
        tuple(None if v is None or v is pd.NaT or v != v else (str(v)[:10] if hasattr(v, "isoformat") else v) for v in r)
        for r in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(clean, key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: schema first, then row count, then values. Empty means equal."""
    relation = con.sql(sql)
    ours = {name: kind(dtype) for name, dtype in spark_df.dtypes}
    theirs = {name: kind(str(dtype)) for name, dtype in zip(relation.columns, relation.types)}
    if ours != theirs:
        return [f"schema {sorted(set(ours.items()) ^ set(theirs.items()))}"]
    left = rows(pd.DataFrame([r.asDict() for r in spark_df.collect()], columns=spark_df.columns))
    right = rows(pd.DataFrame(relation.fetchall(), columns=relation.columns))
    if len(left) != len(right):
        return [f"{len(left)} rows against {len(right)}"]
    return [f"{a} != {b}" for a, b in zip(left, right) if a != b]
