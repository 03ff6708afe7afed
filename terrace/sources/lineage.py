"""Lineage columns of rows that come from files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import number_in_text


def with_lineage(
    df: DataFrame,
    number: str | None = None,
    pattern: str | None = None,
    file_column: str = "source_file",
    time_column: str | None = "ingested_at",
) -> DataFrame:
    """Add the file path, a number cut out of it, and the ingest time.

    Must sit directly above a file scan, batch or stream.
    """
    path = F.col("_metadata.file_path")
    added = {file_column: path}
    if number is not None:
        if pattern is None:
            raise ValueError("a number column needs a pattern")
        added[number] = number_in_text(path, pattern)
    if time_column is not None:
        added[time_column] = F.current_timestamp()
    return df.withColumns(added)
