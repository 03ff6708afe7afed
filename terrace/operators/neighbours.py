"""Where to cut ids that are too large for one task, along the order of their rows.

A window sorts each id inside one task.  An id with more rows than that allows is cut into
pieces; a window then runs per piece, and what lies beyond a cut comes from a second window over
the ends of the pieces.  The result is the same for any choice of cuts, so the cuts
may come from a sample although no row is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.search import with_bounds_below

PIECE = "_piece"
_KEY = "_key"
_CUTS = "_cuts"
_AT = "_at"
_SAMPLE_PER_PIECE = 200
_BROADCAST_PIECES = 100_000


@dataclass(frozen=True)
class Cuts:
    """Ascending cut points per hashed id: at most ``size`` for one id, ``pieces`` for all."""

    frame: DataFrame
    size: int
    pieces: int


def cut_points(
    df: DataFrame,
    ids: Sequence[str],
    order: str,
    ties: Sequence[str] = (),
    rows_per_piece: int = 20_000_000,
) -> Cuts | None:
    """Where to cut the ids that exceed ``rows_per_piece``; ``None`` if there are none.

    This is a planning step of its own: it counts ``df`` and, for a table of more rows than one
    piece, shuffles a sample of about 200 rows per piece.  The cut points, one per piece, reach the
    driver.  Rows are cut by order and tie columns of any type that sorts.
    """
    total = df.count()
    if total <= rows_per_piece:
        return None
    fraction = min(1.0, _SAMPLE_PER_PIECE / rows_per_piece)
    drawn = df.select(F.xxhash64(*ids).alias(_KEY), F.struct(order, *ties).alias("at"))
    if fraction < 1.0:
        drawn = drawn.sample(fraction, seed=17)
    piece = rows_per_piece * fraction
    sampled = drawn.groupBy(_KEY).agg(F.sort_array(F.collect_list("at")).alias("all"))
    pieces = F.ceil(F.size("all") / piece).cast("int")
    place = F.transform(
        F.sequence(F.lit(1), pieces - 1),
        lambda i: F.get("all", F.floor(i * F.size("all") / pieces).cast("int")),
    )
    cuts = sampled.where(F.size("all") > piece).select(_KEY, F.array_distinct(place).alias(_CUTS))
    found = cuts.collect()
    if not found:
        return None
    sizes = [len(row[_CUTS]) for row in found]
    frame = df.sparkSession.createDataFrame(found, cuts.schema)
    return Cuts(frame, max(sizes), sum(sizes) + len(sizes))


def with_piece(
    df: DataFrame, ids: Sequence[str], order: str, ties: Sequence[str], cuts: Cuts
) -> DataFrame:
    """Add the piece of each row, from 0; rows that agree in order and ties share one."""
    frame = F.broadcast(cuts.frame) if cuts.pieces <= _BROADCAST_PIECES else cuts.frame
    keyed = df.withColumn(_KEY, F.xxhash64(*ids)).join(frame, _KEY, "left")
    placed = keyed.withColumn(_AT, F.when(F.col(_CUTS).isNotNull(), F.struct(order, *ties)))
    searched = with_bounds_below(placed, {PIECE: (_AT, F.col(_CUTS))}, cuts.size)
    return searched.drop(_KEY, _CUTS, _AT)
