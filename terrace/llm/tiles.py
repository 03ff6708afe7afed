"""Groups of any size as tiles of bounded size.

``tile`` takes members (node, bucket, band: a node in a bucket of a band) and cuts each bucket with
more than one node into blocks by hash.  A tile is a pair of blocks (i, j); every two nodes of a
bucket meet in exactly one tile, which holds two blocks at most.  Pairs never become rows.  Buckets
that hold the same nodes as another are looked at once, in the first band.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tile = dict[str, np.ndarray]
Links = list[tuple[int, int]]
_KEY = ["bucket", "i", "j"]
_NAMES = ["bucket", "band", "i", "j", "node", "block"]


#: Blocks of large buckets grow to so many times their size at most.
_GROWN = 16


def tile(members: DataFrame, block: int, grow: bool = False) -> DataFrame:
    """bucket, band, i, j, node and its block: one row for each tile that a node is in.

    With ``grow`` blocks are larger in larger buckets, by the root of the number of blocks otherwise, so that a node of a
    large bucket is in fewer tiles.
    """
    groups = (
        members.groupBy("bucket", "band")
        .agg(
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .where("size > 1")
        .groupBy("size", "x", "y")
        .agg(F.min(F.struct("band", "bucket")).alias("first"))
        .select("size", "first.band", "first.bucket")
    )
    blocks = F.col("size") / block
    if grow:
        blocks = F.greatest(F.sqrt(blocks), blocks / _GROWN)
    blocks = F.ceil(blocks).cast("long")
    met = members.join(groups, ["bucket", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("node"), blocks)
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    return met.select("bucket", "band", "node", "block", other).select(
        "bucket",
        "band",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "node",
        "block",
    )


class Forest:
    """Which places of a tile are connected so far."""

    def __init__(self, size: int):
        self._up = list(range(size))

    def root(self, x: int) -> int:
        while self._up[x] != x:
            self._up[x] = self._up[self._up[x]]
            x = self._up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Connect two places; whether they were apart."""
        x, y = self.root(x), self.root(y)
        self._up[y] = x
        return x != y


def whole_tiles(
    frame: DataFrame,
    columns: list[str],
    opened: Callable[[], Callable[[Tile, list[int]], pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """What the function that ``opened`` makes in each task returns for rows of whole tiles.

    It gets the ``columns`` and bucket, band, i, j, node and block of the rows of many tiles, sorted, and the
    places where tiles begin; tiles of one row are among them.
    """
    names = [*_NAMES, *columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        result_of = opened()
        held: Tile | None = None
        for batch in batches:
            rows = {n: batch[n].to_numpy() for n in names}
            if held is not None:
                rows = {n: np.concatenate([held[n], rows[n]]) for n in names}
            key = np.stack([rows[n].astype(np.int64) for n in _KEY])
            starts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()]
            last = starts.pop()  # the last tile may go on in the next batch
            held = {n: rows[n][last:] for n in names}
            if starts:
                yield result_of({n: rows[n][:last] for n in names}, starts)
        if held is not None and len(held["node"]):
            yield result_of(held, [0])

    dealt = frame.select(names).repartition(*_KEY).sortWithinPartitions(*_KEY)
    return dealt.mapInPandas(run, schema)


def links(tiles: DataFrame, columns: list[str], opened: Callable[[], Callable[[Tile], Links]]) -> DataFrame:
    """a and b: the links that the function which ``opened`` makes finds in each tile.

    The function gets the ``columns`` and bucket, band, i, j, node and block as arrays.
    """

    def framed() -> Callable[[Tile, list[int]], pd.DataFrame]:
        links_of = opened()

        def all_links(rows: Tile, starts: list[int]) -> pd.DataFrame:
            found: Links = []
            for a, b in zip(starts, [*starts[1:], len(rows["node"])], strict=True):
                if b - a > 1:
                    found += links_of({n: values[a:b] for n, values in rows.items()})
            return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

        return all_links

    return whole_tiles(tiles, columns, framed, "a long, b long")


def near_hashes(tiles: DataFrame, bits: int) -> DataFrame:
    """bucket, band and node of the tiles' nodes, 64-bit hashes themselves, that differ from another
    in their tile in at most ``bits`` bits.

    Row i is compared with row i + 1, then i + 2 and so on while any tile is as long, so many small
    tiles cost no more than the pairs in them.
    """

    def near(rows: Tile, starts: list[int]) -> pd.DataFrame:
        size = len(rows["node"])
        lengths = np.diff([*starts, size])
        left = np.repeat(np.array([*starts[1:], size]), lengths) - np.arange(size) - 1
        hashes, apart = rows["node"].view(np.uint64), rows["i"] != rows["j"]
        found = np.zeros(size, dtype=bool)
        at = np.arange(size)
        for step in range(1, int(lengths.max(initial=0))):
            at = at[left[at] >= step]  # rows with so many after them in their tile
            close = np.bitwise_count(hashes[at] ^ hashes[at + step]) <= bits
            close &= ~apart[at] | (rows["block"][at] != rows["block"][at + step])
            found[at[close]] = True
            found[at[close] + step] = True
        return pd.DataFrame({n: rows[n][found] for n in ("bucket", "band", "node")})

    return whole_tiles(tiles, [], lambda: near, "bucket long, band int, node long")
