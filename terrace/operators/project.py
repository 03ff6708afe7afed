"""Column selection, renaming and audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.profile import Aliased


def select_strict(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, in that order; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df.select(*columns)


def select_available(
    df: DataFrame, columns: Sequence[str], aliases: Sequence[Aliased] = ()
) -> DataFrame:
    """The listed columns that exist, in list order.

    Every spelling of a listed column counts as listed, so a file that only
    has the second spelling keeps its values.
    """
    spellings = {s: group.spellings for group in aliases for s in group.spellings}
    wanted: dict[str, None] = {}
    for column in columns:
        for spelling in (column, *spellings.get(column, ())):
            wanted.setdefault(spelling)
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def rename(
    df: DataFrame, renames: Mapping[str, str], aliases: Sequence[Aliased] = ()
) -> DataFrame:
    """Apply a rename map and merge alternative spellings, in one projection.

    Absent columns are ignored.  When several spellings of one column are
    present (files of different editions were unioned) the first that is not null
    wins row by row.
    """
    present = df.columns
    merged: dict[str, list[str]] = {}
    for group in aliases:
        found = [s for s in group.spellings if s in present]
        if found:
            merged[group.target] = found
    absorbed = {s: target for target, found in merged.items() for s in found}
    first = {found[0] for found in merged.values()}

    projected = []
    for column in present:
        target = absorbed.get(column)
        if target is None:
            projected.append(F.col(column).alias(renames.get(column, column)))
        elif column in first:
            projected.append(F.coalesce(*map(F.col, merged[target])).alias(target))
    return df.select(*projected)


def add_audit(
    df: DataFrame,
    version: str,
    time_column: str = "processed_at",
    version_column: str = "version",
    at: datetime | None = None,
) -> DataFrame:
    """Add the processing time (now, or a fixed ``at``) and a constant version."""
    stamp = F.current_timestamp() if at is None else F.lit(at)
    return df.withColumns({time_column: stamp, version_column: F.lit(version)})
