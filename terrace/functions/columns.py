"""Scalar expressions.  All are built-in functions, so they stay inside codegen."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.profile import Tier

_WHOLE = ("tinyint", "smallint", "int", "integer", "bigint", "long", "byte", "short")
_FRACTIONAL = ("double", "float")

# What the plain (non-ANSI) cast to a whole number accepts, blanks around it included.
_BLANK = r"[\s\p{Cntrl}]*"
_WHOLE_PART = rf"^{_BLANK}([+-]?\d+)(\.\d*)?{_BLANK}$"
_ONLY_FRACTION = rf"^{_BLANK}[+-]?\.\d*{_BLANK}$"
# How every readable floating-point text begins; enough to stop most other text.
_NUMBER_START = rf"^{_BLANK}[+-]?(\d|\.\d|(?i:inf|nan))"


def tolerant_cast(value: Column, to: str, text: bool = True) -> Column:
    """Cast that turns malformed input into null, whatever the ANSI setting.

    Text such as ``'91.7'`` becomes a whole number by truncation, which a bare
    ``try_cast`` to an integer type rejects.  ``try_cast`` alone also raises and
    catches an exception per malformed value, at 20 times the cost of the
    pattern that keeps such text away from it; it is left to find overflows.
    Patterns are matched only where text is more than digits.
    """
    to = to.lower()
    if text and to in _WHOLE:
        digits = (value != "") & (F.btrim(value, F.lit("0123456789")) == "")
        whole = F.regexp_extract(value, _WHOLE_PART, 1)
        return (
            F.when(digits, value.try_cast(to))
            .when(value.rlike(_WHOLE_PART), whole.try_cast(to))
            .when(value.rlike(_ONLY_FRACTION), F.lit(0).cast(to))
        )
    if text and to in _FRACTIONAL:
        return F.when(value.rlike(_NUMBER_START), value.try_cast(to))
    return value.try_cast(to)


def tier_label(tier: Tier, value: Column) -> Column:
    """The label of the first step that ``value`` satisfies."""
    label = None
    for bound, name in tier.steps:
        reached = value >= bound if tier.op == ">=" else value < bound
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return F.lit(tier.otherwise) if label is None else label.otherwise(tier.otherwise)


def with_default(value: Column, default: Any) -> Column:
    """Replace null, and only null: an empty string stays."""
    return F.coalesce(value, F.lit(default))


def number_in_text(value: Column, pattern: str, group: int = 1) -> Column:
    """A whole number cut out of text; null where the pattern does not match."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit("")).try_cast("int")


def holds(predicate: str) -> Column:
    """TRUE where the predicate is TRUE, FALSE where it is FALSE or unknown."""
    return F.coalesce(F.expr(predicate), F.lit(False))
