"""Run a query and its SQL side by side and compare them as sets of rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=repr)


def differences(df, con, sql) -> list[str]:
    """Human-readable differences; empty when both sides agree."""
    rel = con.sql(sql)
    out = []
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    got_types = {f.name: SAME_TYPE.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    if set(want_types) != set(got_types):
        return [f"columns: {sorted(got_types)} vs {sorted(want_types)}"]
    if want_types != got_types:
        out.append(f"types: { {k: (got_types[k], want_types[k]) for k in got_types if got_types[k] != want_types[k]} }")
    got, want = _rows(df.columns, df.collect()), _rows(rel.columns, rel.fetchall())
    if len(got) != len(want):
        out.append(f"row count: {len(got)} vs {len(want)}")
    if got != want:
        only_got, only_want = set(got) - set(want), set(want) - set(got)
        out.append(f"values: {len(only_got)} only ours {sorted(only_got, key=repr)[:3]}")
        out.append(f"values: {len(only_want)} only SQL {sorted(only_want, key=repr)[:3]}")
    return out
