"""Comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, Decimal):
        return f"{value:f}"
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_plain(r[k]) for k in order) for r in rows), key=repr)


FAMILY = {
    "bigint": "int", "int": "int", "smallint": "int", "integer": "int", "string": "text", "varchar": "text",
    "timestamp": "time", "timestamp_ntz": "time", "date": "date", "boolean": "bool", "double": "float",
}


def _family(name: str) -> str:
    return FAMILY.get(name.lower(), name.lower().replace(" ", ""))


def difference(result, con, sql) -> str | None:
    """What differs, or None."""
    expected = con.sql(sql)
    got_types = {c: _family(t) for c, t in result.dtypes}
    want_types = {c: _family(str(t)) for c, t in zip(expected.columns, expected.types)}
    if got_types != want_types:
        return f"schema: {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    want = _rows(expected.columns, expected.fetchall())
    if len(got) != len(want):
        return f"rows: {len(got)} against {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference: {a} against {b}"
    return None
