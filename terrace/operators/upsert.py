"""Keyed latest-wins reduction (type 1 upsert)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame, keys: Sequence[str], sequence: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Per key the row with the greatest ``sequence``; ``ties`` settle equal ones.

    Tie columns that ``df`` lacks are skipped: a column may arrive with a later batch.
    Spark keeps one row per key and map task before the shuffle (a partial group
    limit), so a key that holds a third of all rows does not reach one reducer.
    """
    ties = [t for t in ties if t in df.columns]
    newest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in (sequence, *ties)]
    )
    return df.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")


def upsert(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    ties: Sequence[str] = (),
) -> DataFrame:
    """``current`` after ``changes``: new keys insert, older sequences are ignored.

    The result does not depend on the order of batches, and applying a batch twice
    changes nothing.
    """
    return latest_by_key(
        current.unionByName(changes, allowMissingColumns=True), keys, sequence, ties
    )
