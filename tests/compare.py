"""Run a query on Spark and its SQL check on DuckDB, and compare whole results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def session(name: str = "hackney-tests", cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(names: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and all values agree exactly, in any row order."""
    found = []
    spark_types = {name: _TYPES.get(kind, kind) for name, kind in frame.dtypes}
    result = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in result.description}
    if spark_types != duck_types:
        odd = {k for k in spark_types.keys() | duck_types if spark_types.get(k) != duck_types.get(k)}
        found.append("types: " + ", ".join(f"{k} {spark_types.get(k)}/{duck_types.get(k)}" for k in sorted(odd)))
        if spark_types.keys() != duck_types.keys():
            return found
    expected = _rows(list(duck_types), result.fetchall())
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if len(actual) != len(expected):
        found.append(f"rows: {len(actual)}/{len(expected)}")
    if actual != expected:
        spark_only, duck_only = sorted(set(actual) - set(expected)), sorted(set(expected) - set(actual))
        found.append(f"values: {len(spark_only)} only here, {len(duck_only)} only in SQL")
        found += [f"  + {r}" for r in spark_only[:3]] + [f"  - {r}" for r in duck_only[:3]]
    return found
