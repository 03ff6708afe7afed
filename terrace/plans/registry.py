"""Every query of the toolkit on the given tables, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A named query: how Spark builds it and the equivalent plain SQL."""

    name: str
    build: Build
    sql: str


_REGISTRY: dict[str, Query] = {}


def query(sql: str) -> Callable[[Build], Build]:
    """Register a function under its own name, next to its SQL."""

    def register(build: Build) -> Build:
        name = build.__name__
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} exists already")
        _REGISTRY[name] = Query(name, build, sql)
        return build

    return register


def all_queries() -> dict[str, Query]:
    """All registered queries by name."""
    from terrace.plans import queries_clean, queries_curate, queries_players, queries_store  # noqa: F401

    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
