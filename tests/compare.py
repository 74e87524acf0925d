"""Run a query and its SQL on the same tables and compare rows."""

import datetime as dt
import decimal
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _kind(value):
    return "number" if isinstance(value, (int, float)) and not isinstance(value, bool) else type(value).__name__


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, sql):
    """List of differences, [] if none."""
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    want_cols = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return [f"columns {sorted(got_cols)} != {sorted(want_cols)}"]
    a, b = _sorted(got_cols, got), _sorted(want_cols, want)
    problems = []
    if len(a) != len(b):
        problems.append(f"{len(a)} rows != {len(b)} rows")
    kinds = {n: str(t) for n, t in zip(want_cols, [d[1] for d in result.description])}
    for name, kind in df.dtypes:
        pair = (kind, kinds[name])
        ok = {
            "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
            "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
        }.get(kind)
        if ok != pair[1]:
            problems.append(f"type of {name}: {pair[0]} != {pair[1]}")
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        problems.append(f"{len(diff)} rows differ, first: {diff[0]}")
    return problems
