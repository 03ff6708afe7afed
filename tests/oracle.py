"""Compare a Spark result with the same query in DuckDB, ignoring row order."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

_TYPES = {
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between both results, or ``None``."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    types = {d[0]: str(d[1]).upper() for d in answer.description}
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    for name, spark_type in result.dtypes:
        if _TYPES.get(spark_type, spark_type) != types[name]:
            return f"type of {name}: {spark_type} != {types[name]}"
    order = sorted(names)
    theirs = Counter(
        tuple(_plain(row[names.index(c)]) for c in order) for row in answer.fetchall()
    )
    ours = Counter(tuple(_plain(row[c]) for c in order) for row in result.collect())
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows != {sum(theirs.values())} rows; only in Spark "
            f"{list((ours - theirs).items())[:3]}; only in SQL {list((theirs - ours).items())[:3]}"
        )
    return None


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value
