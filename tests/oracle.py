"""Comparing a Spark result with DuckDB on the same parquet files."""

from __future__ import annotations

import glob
import os

import duckdb

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df, con, sql: str) -> str:
    """Empty if names, types and the bag of rows agree, else what differs."""
    relation = con.sql(sql)
    ours = {f.name: TYPES.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    theirs = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    if ours != theirs and dict(sorted(ours.items())) != dict(sorted(theirs.items())):
        return f"schema {ours} != {theirs}"
    names = sorted(ours)
    got = sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect())))
    order = [relation.columns.index(n) for n in names]
    want = sorted(map(repr, (tuple(r[i] for i in order) for r in relation.fetchall())))
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows != {len(want)} rows; extra {extra}; missing {missing}"
    return ""
