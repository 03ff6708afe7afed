"""Joins with a table of unique keys in which a few keys may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def looked_up(frame: DataFrame, key: str, table: DataFrame, heavy: int = 1000) -> DataFrame:
    """``frame`` with the columns of ``table``, unique by ``key``, or nulls where it lacks the key.

    Keys that hold more than a ``heavy``-th of the rows, of which there are fewer than ``heavy``, are
    broadcast, so that the rows of such a key stay where they are.  ``frame`` is read three times.
    """
    size = frame.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_size"))
    most = max(1, frame.count() // heavy)
    hot = size.where(F.col("_size") > most).select(key, F.lit(True).alias("_hot"))
    marked = frame.join(F.broadcast(hot), key, "left")
    often = table.join(F.broadcast(hot), key, "left_semi")
    some = marked.where("_hot").drop("_hot").join(F.broadcast(often), key, "left")
    return some.unionByName(marked.where("_hot IS NULL").drop("_hot").join(table, key, "left"))
