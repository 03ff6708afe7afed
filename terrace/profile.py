"""Declarative settings of a pipeline: what to keep, cast, rename, default, tier and check.

A profile is plain data.  The operators turn it into DataFrame expressions, so a
new domain needs a new profile and no new code.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Aliased:
    """One output column that sources spell in several ways, best spelling first."""

    target: str
    spellings: tuple[str, ...]


@dataclass(frozen=True)
class Tier:
    """A label chosen by walking ``steps`` in order and taking the first that holds.

    ``op`` is ``">="`` for a descending ladder or ``"<"`` for an ascending one.
    A null input satisfies no step and gets ``otherwise``.
    """

    target: str
    source: str
    op: str
    steps: tuple[tuple[float, str], ...]
    otherwise: str

    def __post_init__(self) -> None:
        if self.op not in (">=", "<"):
            raise ValueError(f"tier {self.target!r}: op must be '>=' or '<', not {self.op!r}")
        bounds = [bound for bound, _ in self.steps]
        if bounds != sorted(bounds, reverse=self.op == ">="):
            raise ValueError(f"tier {self.target!r}: a later step can never be reached")


@dataclass(frozen=True)
class Gap:
    """``target = high - low``; may be negative."""

    target: str
    high: str
    low: str


@dataclass(frozen=True)
class Rule:
    """A named data-quality predicate in SQL.  It passes only when it is TRUE.

    ``action`` is ``"drop"`` (remove failing rows) or ``"warn"`` (count them only).
    """

    name: str
    predicate: str
    action: str = "drop"

    def __post_init__(self) -> None:
        if self.action not in ("drop", "warn"):
            raise ValueError(f"rule {self.name!r}: action must be 'drop' or 'warn'")


@dataclass(frozen=True)
class Measure:
    """One aggregate of a summary; ``column=None`` counts rows."""

    target: str
    fn: str
    column: str | None = None
    digits: int | None = None


@dataclass(frozen=True)
class Profile:
    """Settings of the cleaning chain, in the order in which they apply."""

    required: tuple[str, ...]
    casts: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)
    aliases: tuple[Aliased, ...] = ()
    trimmed: tuple[str, ...] = ()
    uppered: tuple[str, ...] = ()
    defaults: Mapping[str, Any] = field(default_factory=dict)
    tiers: tuple[Tier, ...] = ()
    gaps: tuple[Gap, ...] = ()
    rules: tuple[Rule, ...] = ()
    keys: tuple[str, ...] = ()
    time_column: str = "processed_at"
    version_column: str = "version"
    version: str = "1.0"
