"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from marketflow.suite.registry import TABLES

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sorted(rows):
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and the SQL's result; empty when they agree."""
    cols = sorted(df.columns)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    out = []
    if sorted(names) != cols:
        return [f"columns {cols} / {sorted(names)}"]
    kinds = dict(df.dtypes)
    for c in cols:
        want = SPARK_TO_DUCK.get(kinds[c])
        if want != types[c]:
            out.append(f"type of {c}: spark {kinds[c]}, duckdb {types[c]}")
    at = [names.index(c) for c in cols]
    theirs = _sorted([tuple(r[i] for i in at) for r in rel.fetchall()])
    ours = _sorted([tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()])
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} / {len(theirs)}")
    if not ours:
        out.append("no rows")
    if ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        out.append(f"{len(bad)} rows differ, first {bad[:2]}")
    return out
