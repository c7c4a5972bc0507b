"""Compare a query with its SQL twin: names, types, and rows in any order."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

from coursegrain.bindings.registry import TABLES

# Spark type name -> types the SQL side may report.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR", "\"NULL\"", "INTEGER"},
    "boolean": {"BOOLEAN"},
    "timestamp": {"TIMESTAMP"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences; empty when both sides agree."""
    rows = [tuple(_cell(v) for v in r) for r in df.collect()]
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    names = sorted(n for n, _ in described)
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    found = []
    sql_types = dict(described)
    for name, kind in df.dtypes:
        if sql_types[name] not in SAME_TYPE.get(kind, set()):
            found.append(f"type of {name}: {kind} != {sql_types[name]}")
    place = [[n for n, _ in described].index(c) for c in df.columns]
    other = [tuple(_cell(r[i]) for i in place) for r in cursor.fetchall()]
    if len(rows) != len(other):
        found.append(f"rows {len(rows)} != {len(other)}")
    a, b = sorted(rows, key=_key), sorted(other, key=_key)
    if a != b:
        sa, sb = set(rows), set(other)
        found.append(f"only spark: {sorted(sa - sb, key=_key)[:4]}")
        found.append(f"only sql:   {sorted(sb - sa, key=_key)[:4]}")
        if sa == sb:
            found.append("same rows, other multiplicity")
    return found
