"""Change history of one attribute per id (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.neighbours import PIECE, Cuts, cut_points, with_piece

_BEFORE = "_before"
_FOLLOWING = "_following"
_LAST = "_last"
_PLACE = "_place"
_MORE = "_more"
_GROUP = "_group"
_REAL = "_real"
_ENDS = -1


def change_history(
    df: DataFrame,
    ids: Sequence[str],
    order: str,
    tracked: str,
    closing: str = "appearance",
    offset: int | None = None,
    ties: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    start: str = "start_year",
    end: str = "end_year",
    current: str = "is_current",
    rows_per_piece: int | None = 20_000_000,
) -> DataFrame:
    """One row per change of ``tracked``, with the period in which it held.

    A row is a change when it is the first of its id, when the previous value is
    null, or when the value differs from the previous one.

    ``closing="appearance"`` ends a period at the next row of the id, changed or not,
    and calls a change current only if no row follows it.  An id whose last row
    is no change then has no current row.  ``closing="change"`` ends a period at
    the next change, so periods touch and every id has exactly one current row.

    ``offset`` is added to both period bounds (an edition number plus a century).
    One shuffle on ``ids`` serves both window passes.  Ids with more rows than
    ``rows_per_piece`` are split over tasks, which takes one more shuffle of the rows that may be
    changes.  Finding them is a planning step that runs while the DataFrame is built (see
    ``cut_points``); pass ``None`` where the rows per id are known to be few.
    """
    if closing not in ("appearance", "change"):
        raise ValueError(f"closing must be 'appearance' or 'change', not {closing!r}")
    kept = list(df.columns if columns is None else columns)
    needed = dict.fromkeys([*kept, *ids, order, tracked, *ties])
    rows = df.select(*needed)
    cuts = None
    if rows_per_piece is not None:
        cuts = cut_points(rows, ids, order, ties, rows_per_piece)
    if cuts is None:
        changes = _changes(rows, ids, order, ties, tracked, closing)
    else:
        changes = _changes_by_piece(rows, ids, order, ties, tracked, closing, cuts)
    following = F.col(_FOLLOWING)[order]
    return changes.select(
        *kept,
        _shift(F.col(order), offset).alias(start),
        _shift(following, offset).alias(end),
        following.isNull().alias(current),
    )


def _is_change(before: Column, tracked: str) -> Column:
    return before.isNull() | before[tracked].isNull() | (F.col(tracked) != before[tracked])


def _changes(
    rows: DataFrame, ids: Sequence[str], order: str, ties: Sequence[str], tracked: str, closing: str
) -> DataFrame:
    """The changes, with a struct of the order value that ends each."""
    window = Window.partitionBy(*ids).orderBy(order, *ties)
    following = F.lead(F.struct(order)).over(window)
    wanted = {_BEFORE: F.lag(F.struct(tracked)).over(window)}
    if closing == "appearance":
        wanted[_FOLLOWING] = following
    changes = rows.withColumns(wanted).where(_is_change(F.col(_BEFORE), tracked))
    return changes if closing == "appearance" else changes.withColumn(_FOLLOWING, following)


def _changes_by_piece(
    rows: DataFrame,
    ids: Sequence[str],
    order: str,
    ties: Sequence[str],
    tracked: str,
    closing: str,
    cuts: Cuts,
) -> DataFrame:
    """The same where ids are cut into pieces.

    The first window runs per piece.  It leaves the rows that are changes, or are the first of their
    piece and may be; each carries the last value of its piece.  The second window runs over the
    ends of an id's pieces, two rows each: a first row sees there what came before it, and a
    last one what follows it.  Rows between the ends know both already and stay with their piece.
    """
    pieced = with_piece(rows, ids, order, ties, cuts)
    piece = Window.partitionBy(*ids, PIECE).orderBy(order, *ties)
    following = F.lead(F.struct(order)).over(piece)
    whole = piece.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = {
        _BEFORE: F.lag(F.struct(tracked)).over(piece),
        _PLACE: F.row_number().over(piece),
        _LAST: F.last(F.struct(tracked)).over(whole),
    }
    if closing == "appearance":
        wanted[_FOLLOWING] = following
    likely = pieced.withColumns(wanted).where(_is_change(F.col(_BEFORE), tracked))
    if closing == "change":
        likely = likely.withColumn(_FOLLOWING, following)
    first = F.col(_PLACE) == 1
    likely = likely.withColumn(_MORE, F.lead(F.lit(True)).over(piece))
    is_end = first | F.col(_MORE).isNull()
    likely = likely.withColumn(_GROUP, F.when(is_end, F.lit(_ENDS)).otherwise(F.col(PIECE)))

    ends = Window.partitionBy(*ids, _GROUP).orderBy(PIECE, _PLACE)
    backwards = Window.partitionBy(*ids, _GROUP).orderBy(F.desc(PIECE), F.desc(_PLACE))
    before = F.when(first, F.lag(_LAST).over(ends)).otherwise(F.col(_BEFORE))
    seen = likely.withColumn(_BEFORE, before)
    seen = seen.withColumn(_REAL, _is_change(F.col(_BEFORE), tracked))
    if closing == "appearance":
        beyond = F.lead(F.struct(order)).over(ends)
    else:
        starts = F.when(F.col(_REAL), F.struct(order)).otherwise(F.col(_FOLLOWING))
        later = backwards.rowsBetween(Window.unboundedPreceding, -1)
        beyond = F.last(F.when(first, starts), ignorenulls=True).over(later)
    ended = seen.withColumn(_FOLLOWING, F.coalesce(_FOLLOWING, beyond))
    return ended.where(_REAL)


def _shift(value: Column, offset: int | None) -> Column:
    return value if offset is None else value + offset
