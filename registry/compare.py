"""Runs a query and its SQL on DuckDB over the same Parquet files and compares schema and rows."""

from __future__ import annotations

import datetime
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def duck_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, sql: str, connection) -> list[str]:
    """Differences between a DataFrame and the SQL result; empty if they agree."""
    cursor = connection.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    duck_names = [d[0] for d in cursor.description]
    duck_rows = cursor.fetchall()
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    problems = []
    if sorted(duck_names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(duck_names)}"]
    for name, kind in spark_types.items():
        expected = TYPE_NAMES.get(kind, kind.upper())
        if expected != duck_types[name] and not kind.startswith(("array", "struct", "map")):
            problems.append(f"type of {name}: {kind} against {duck_types[name]}")
    ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _sorted_rows(duck_names, duck_rows)
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    if ours != theirs:
        extra, missing = [r for r in ours if r not in set(theirs)][:2], [r for r in theirs if r not in set(ours)][:2]
        problems.append(f"rows differ: ours {extra}, theirs {missing}")
    return problems
