"""Ad-hoc reports: counts, frequent values and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, where: str | None = None, name: str = "row_count") -> DataFrame:
    """One row with the number of (matching) rows."""
    kept = df if where is None else df.where(where)
    return kept.agg(F.count(F.lit(1)).alias(name))


def counts_by(df: DataFrame, *keys: str, name: str = "row_count") -> DataFrame:
    """Rows per group, sorted by the group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)


def top_values(
    df: DataFrame, column: str, n: int, where: str | None = None, name: str = "count"
) -> DataFrame:
    """The ``n`` most frequent values; equal counts are ordered by the value."""
    kept = df if where is None else df.where(where)
    counted = kept.groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return top_rows(counted.distinct(), n, name, ties=(column,))


def top_rows(
    df: DataFrame,
    n: int,
    by: str,
    ties: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """The ``n`` rows with the greatest ``by``; ``ties`` (ascending) settle equal values.

    Sort and limit stay adjacent, so Spark keeps ``n`` rows per task and never sorts
    the whole input.  Nulls come last.
    """
    kept = df if where is None else df.where(where)
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    kept = kept.orderBy(*order).limit(n)
    return kept if columns is None else kept.select(*columns)


def preview(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows; reads no more than it needs."""
    return df.limit(n)


def load_report(df: DataFrame, by: str, current: str | None = None) -> DataFrame:
    """Rows per ``by`` value and, in the same pass, how many satisfy ``current``."""
    measures = [F.count(F.lit(1)).alias("row_count")]
    if current is not None:
        measures.append(F.count_if(F.expr(current)).alias("current_count"))
    return df.groupBy(by).agg(*measures).orderBy(by)
