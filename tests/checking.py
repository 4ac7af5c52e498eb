"""Runs a query and its SQL twin on the same tables and compares them."""

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def family(kind: str) -> str:
    """Types that count as the same on both sides."""
    kind = kind.lower()
    if kind.startswith("decimal"):
        return "decimal"
    return {"integer": "int", "varchar": "string"}.get(kind, kind)


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def differences(spark_df, connection, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result; empty if nothing does."""
    names = sorted(spark_df.columns)
    found = connection.execute(sql)
    sql_types = {d[0]: family(str(d[1])) for d in found.description}
    positions = [d[0] for d in found.description]
    sql_rows = found.fetchall()
    if names != sorted(positions):
        return [f"columns {names} against {sorted(positions)}"]
    spark_types = {name: family(kind) for name, kind in spark_df.dtypes}
    problems = [f"{n}: {spark_types[n]} against {sql_types[n]}" for n in names if spark_types[n] != sql_types[n]]
    left = ordered([tuple(normal(row[n]) for n in names) for row in spark_df.collect()])
    right = ordered([tuple(normal(row[positions.index(n)]) for n in names) for row in sql_rows])
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems
