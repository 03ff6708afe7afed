"""The cleaning chain: select, cast, rename, standardise, default, derive, audit.

The order is a contract, because every step after the rename uses the new names.
Each step is one projection; Catalyst collapses them into a single Project, so
the chain costs no shuffle and works unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.columns import tier_label, tolerant_cast, with_default
from terrace.operators.project import add_audit, rename, select_available, select_strict
from terrace.profile import Gap, Profile, Tier


def apply_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that exist; malformed values become null."""
    text = {f.name: isinstance(f.dataType, T.StringType) for f in df.schema}
    return df.withColumns(
        {c: tolerant_cast(F.col(c), to, text[c]) for c, to in casts.items() if c in text}
    )


def standardize(
    df: DataFrame, trimmed: Sequence[str] = (), uppered: Sequence[str] = ()
) -> DataFrame:
    """Trim blanks from ``trimmed``; upper-case and trim ``uppered``."""
    present = set(df.columns)
    changes = {c: F.trim(c) for c in trimmed if c in present}
    changes |= {c: F.trim(F.upper(c)) for c in uppered if c in present}
    return df.withColumns(changes)


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls by the default of the column, where the column exists."""
    present = set(df.columns)
    return df.withColumns(
        {c: with_default(F.col(c), value) for c, value in defaults.items() if c in present}
    )


def add_tiers(df: DataFrame, tiers: Sequence[Tier]) -> DataFrame:
    """Add one label column per tier."""
    _need(df, [t.source for t in tiers])
    return df.withColumns({t.target: tier_label(t, F.col(t.source)) for t in tiers})


def add_gaps(df: DataFrame, gaps: Sequence[Gap]) -> DataFrame:
    """Add one difference column per gap."""
    _need(df, [c for g in gaps for c in (g.high, g.low)])
    return df.withColumns({g.target: F.col(g.high) - F.col(g.low) for g in gaps})


def clean(
    df: DataFrame,
    profile: Profile,
    select: str | None = "available",
    at: datetime | None = None,
) -> DataFrame:
    """Run the whole chain; ``select`` is ``"available"``, ``"strict"`` or ``None``."""
    if select == "available":
        df = select_available(df, profile.required, profile.aliases)
    elif select == "strict":
        df = select_strict(df, profile.required)
    elif select is not None:
        raise ValueError(f"unknown select mode {select!r}")
    return (
        df.transform(apply_casts, profile.casts)
        .transform(rename, profile.renames, profile.aliases)
        .transform(standardize, profile.trimmed, profile.uppered)
        .transform(fill_defaults, profile.defaults)
        .transform(add_tiers, profile.tiers)
        .transform(add_gaps, profile.gaps)
        .transform(
            add_audit, profile.version, profile.time_column, profile.version_column, at
        )
    )


def _need(df: DataFrame, columns: Sequence[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"derived columns need: {', '.join(missing)}")
