"""Compares the rows of a Spark query with those of its SQL twin in DuckDB."""

from __future__ import annotations

import datetime
import math

import duckdb

from skyledger.plans.adapters import TABLES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


NO_ROWS = "no rows"


def plain(value):
    """A value in a form that compares and sorts in both engines."""
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, (int, float)):
        return (2, "nan") if math.isnan(value) else (2, value)
    if isinstance(value, datetime.datetime):
        return (3, value.replace(tzinfo=None).isoformat())
    if isinstance(value, (list, tuple)):
        return (4, tuple(plain(item) for item in value))
    return (5, str(value))


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


SPARK_TYPE = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def difference(df, connection, sql: str) -> str | None:
    """What differs, or None."""
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    theirs = {column[0]: SPARK_TYPE.get(str(column[1]), str(column[1])) for column in result.description}
    if dict(df.dtypes) != theirs:
        return f"schema {sorted(set(df.dtypes) ^ set(theirs.items()))}"
    wanted = rows_of(columns, result.fetchall())
    found = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if len(found) != len(wanted):
        return f"{len(found)} rows != {len(wanted)}"
    for mine, theirs in zip(found, wanted):
        if mine != theirs:
            return f"{mine}\n!= {theirs}"
    return None if wanted else NO_ROWS
