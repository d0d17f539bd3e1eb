"""Compare a query with its SQL oracle on the same tables."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


_TYPES = {
    "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "INTEGER": "int",
}


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return str(value)  # 0.0 and -0.0 differ
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types and the bag of rows agree exactly."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: _TYPES.get(str(c[1]), str(c[1])) for c in result.description}
    expected_rows = result.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} expected {sorted(names)}"]
    for field in df.schema.fields:
        if field.dataType.simpleString() != types[field.name]:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} "
                         f"expected {types[field.name]}")
    order = sorted(names)
    expected = Counter(
        tuple(_plain(r[names.index(n)]) for n in order) for r in expected_rows)
    actual = Counter(tuple(_plain(r[n]) for n in order) for r in df.collect())
    if actual != expected:
        found.append(f"rows {sum(actual.values())} expected {sum(expected.values())}; "
                     f"extra {list((actual - expected).items())[:3]} "
                     f"missing {list((expected - actual).items())[:3]}")
    return found
