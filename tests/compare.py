"""Compare a Spark result with a DuckDB result: columns, types, rows, in any row order."""

from __future__ import annotations

import math

import duckdb

from rillwork.plans.registry import TABLES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


SAME_TYPE = {
    "tinyint": "byte",
    "smallint": "short",
    "integer": "int",
    "bigint": "bigint",
    "double": "double",
    "float": "float",
    "varchar": "string",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
}


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def key(row):
    return tuple((v is None, str(type(v)), repr(v)) for v in row)


def differences(spark_df, connection, sql: str) -> str | None:
    """A description of the first difference, or None."""
    names = sorted(spark_df.columns)
    cursor = connection.execute(sql)
    described = {d[0]: str(d[1]).lower() for d in cursor.description}
    fetched = cursor.fetchall()
    if sorted(described) != names:
        return f"columns {names} and {sorted(described)}"
    types = dict(spark_df.dtypes)
    for n in names:
        duck_type = SAME_TYPE.get(described[n], described[n])
        if types[n] != duck_type and not (types[n] == "timestamp" and duck_type == "timestamp_ntz"):
            return f"type of {n}: {types[n]} and {described[n]}"
    at = [list(described).index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in fetched), key=key)
    got = sorted((tuple(plain(r[n]) for n in names) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()), key=key)
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference {g} and {w}"
    return None


__all__ = ["differences", "duck"]
