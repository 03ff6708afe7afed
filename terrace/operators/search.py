"""Where a value falls among sorted bounds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_bounds_below(
    df: DataFrame, searches: Mapping[str, tuple[str, Column]], size: int
) -> DataFrame:
    """For each target count the bounds below the value of a column; null counts as 0.

    ``searches`` maps a target to (column, ascending array of at most ``size`` bounds).
    Each step of the binary search is one projection.  The steps use the result
    of the one before several times, so Spark keeps them apart and generates a few
    compares per row, where one nested CASE would outgrow the JIT compiler and an array
    function would walk over all bounds.
    """
    df = df.withColumns({target: F.lit(0) for target in searches})
    for bit in reversed(range(size.bit_length())):
        width = 1 << bit
        step = {}
        for target, (column, bounds) in searches.items():
            found = F.col(target)
            above = F.col(column) > F.get(bounds, found + (width - 1))
            step[target] = F.when(above, found + width).otherwise(found)
        df = df.withColumns(step)
    return df
