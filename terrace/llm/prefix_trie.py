"""The prefix trie of conversations, through z-fast tries of bounded size.

A node is a distinct sequence of first turns; the root is the empty one.

1. A turn becomes the digest of its role and text, so that texts are not shuffled.  Turns are dealt
   by conversation, in order, and stream past a running digest: the key of each prefix.
2. Each task puts whole conversations into a z-fast trie, a compacted trie whose nodes (edges of
   the tree of turns) are hashed by one prefix of theirs: the handle, at the depth within the edge that is
   divisible by the greatest power of two.  A fat binary search over these depths leads to the edge
   where a conversation leaves the trie, in as many look-ups as its length has bits.  A trie takes a
   batch of conversations, up to ``Settings.turns`` turns; then its edges are expanded to one row per depth
   with the members so far, and the next batch begins with an empty trie.
3. Rows of one prefix are summed over all batches, before and after the shuffle, so a beginning that
   a third of all conversations share is one row per batch.  A conversation longer than a batch is not
   held: its prefixes go out as rows of their own as they stream past.
4. Sums over subtrees double their reach in each round (a node adds what the nodes 2^r below it
   have, and looks 2^(r+1) up).  Only prefixes of several conversations take part: below one of a single
   conversation there is one leaf and nothing to save.
5. Conversations that end at a node are joined in ascending order in pieces of bounded size; the
   pieces of a node stream past one SHA-256, which can only be computed from front to back.

Null roles and texts are empty, null turns come first; turns that agree in number are in the
order of role and digest, so repeated rows are repeated turns.  Rows without conv_id belong to no
conversation and take no part.  Texts are hashed whole.  Other columns are not read,
whatever their names.  Without conversations there is no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.lookup import looked_up
from terrace.session import scratch_path

ROOT = bytes(16)
_NODES = "key binary, depth int, parent binary, bytes long, n long, least long"
_PARTS = f"{_NODES}, conv_id long"


@dataclass(frozen=True)
class Settings:
    turns: int = 200_000
    ends_per_piece: int = 10_000
    heavy: int = 1000


def turn_table(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), symbol (digest of role and text) and bytes of each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    symbol = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit("|"), role, text), 256))
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role"), F.col("symbol")
    )
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        symbol.alias("symbol"), F.octet_length(text).cast("long").alias("bytes"),
    )
    return turns.select("conv_id", F.row_number().over(order).alias("place"), "symbol", "bytes")


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the greatest power of two."""
    return high & -1 << (low ^ high).bit_length() - 1


@dataclass
class _Edge:
    """The prefixes of ``keys`` deeper than ``top``, down to ``bottom``."""

    keys: list[bytes]
    sizes: list[int]
    top: int
    bottom: int
    n: int = 0
    least: int | None = None

    @property
    def handle(self) -> bytes:
        return self.keys[fattest(self.top, self.bottom)]


@dataclass
class ZFastTrie:
    """Conversations as lists of prefix keys, the root's first."""

    handles: dict[bytes, _Edge] = field(default_factory=dict)
    below: dict[bytes, _Edge] = field(default_factory=dict)  # by the first key of an edge
    root: _Edge = field(default_factory=lambda: _Edge([ROOT], [0], -1, 0))

    def exit(self, keys: list[bytes]) -> tuple[_Edge, int]:
        """The edge where ``keys`` leaves the trie, and how many of its turns the trie has."""
        edge, low, high = self.root, 0, len(keys) - 1
        while low < high:
            depth = fattest(low, high)
            found = self.handles.get(keys[depth])
            if found is None:
                high = depth - 1
            else:
                edge, low = found, found.bottom
        if edge.bottom < len(keys) and edge.keys[edge.bottom] == keys[edge.bottom]:
            if edge.bottom == len(keys) - 1 or keys[edge.bottom + 1] not in self.below:
                return edge, edge.bottom
            edge = self.below[keys[edge.bottom + 1]]
        # both agree at top + 1; the last depth at which they do
        low, high = edge.top + 1, min(edge.bottom, len(keys) - 1)
        while low < high:
            middle = (low + high + 1) // 2
            if edge.keys[middle] == keys[middle]:
                low = middle
            else:
                high = middle - 1
        return edge, low

    def add(self, keys: list[bytes], sizes: list[int], conv_id: int) -> None:
        edge, depth = self.exit(keys)
        if depth < edge.bottom:
            edge = self._cut(edge, depth)
        if depth < len(keys) - 1:
            edge = self._hang(_Edge(keys, sizes, depth, len(keys) - 1))
        edge.n += 1
        edge.least = conv_id if edge.least is None else min(edge.least, conv_id)

    def _hang(self, edge: _Edge) -> _Edge:
        self.handles[edge.handle] = edge
        self.below[edge.keys[edge.top + 1]] = edge
        return edge

    def _cut(self, edge: _Edge, depth: int) -> _Edge:
        """Split an edge in two; returns the upper one, which ends at ``depth``."""
        del self.handles[edge.handle]
        upper = _Edge(edge.keys, edge.sizes, edge.top, depth)
        edge.top = depth
        self._hang(edge)
        return self._hang(upper)

    def expanded(self) -> Iterator[tuple]:
        """key, depth, parent, bytes, members and least member of every prefix."""
        at_end = {e.keys[e.bottom]: e for e in (self.root, *self.below.values())}
        for edge in sorted(self.below.values(), key=lambda e: -e.bottom):
            above = at_end[edge.keys[edge.top]]
            above.n += edge.n
            above.least = edge.least if above.least is None else min(above.least, edge.least)
        if self.root.n:
            yield ROOT, 0, None, 0, self.root.n, self.root.least
        for edge in self.below.values():
            for depth in range(edge.top + 1, edge.bottom + 1):
                yield edge.keys[depth], depth, edge.keys[depth - 1], edge.sizes[depth], edge.n, edge.least


def _next(key: bytes, symbol: bytes) -> bytes:
    return hashlib.blake2b(key + symbol, digest_size=16).digest()


def _parts(turns: DataFrame, settings: Settings) -> DataFrame:
    """Prefixes of batches, and (with conv_id) the last prefix of each conversation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        trie, held = ZFastTrie(), 0
        conv, keys, sizes, streamed = None, [ROOT], [0], 0

        def framed() -> pd.DataFrame:
            rows = [(*r, None) if len(r) == 6 else r for r in out]
            out.clear()
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _PARTS.split(", ")])
            return frame.astype({c: "Int64" for c in ("depth", "bytes", "n", "least", "conv_id")})

        def ended() -> None:
            nonlocal trie, held
            out.append((keys[-1], None, None, None, None, None, conv))
            if streamed:
                spill()
            else:
                trie.add(keys, sizes, conv)
                held += len(keys)

        def spill() -> None:
            """Prefixes of a conversation that is longer than a batch."""
            if not streamed:
                out.append((ROOT, 0, None, 0, 1, conv))
            for n in range(1, len(keys)):
                out.append((keys[n], streamed + n, keys[n - 1], sizes[n], 1, conv))

        for batch in batches:
            for row in zip(batch["conv_id"].tolist(), batch["place"].tolist(), batch["symbol"],
                           batch["bytes"].tolist(), strict=True):
                if row[0] != conv:
                    if conv is not None:
                        ended()
                    if held >= settings.turns:
                        out.extend(trie.expanded())
                        trie, held = ZFastTrie(), 0
                    conv, keys, sizes, streamed = row[0], [ROOT], [0], 0
                if row[1] == 0:
                    continue
                if len(keys) > settings.turns:
                    spill()
                    streamed += len(keys) - 1
                    keys, sizes = keys[-1:], sizes[-1:]
                keys.append(_next(keys[-1], bytes(row[2])))
                sizes.append(row[3])
                if len(out) >= 50_000:
                    yield framed()
            if out:
                yield framed()
        if conv is not None:
            ended()
        for some in trie.expanded():
            out.append(some)
            if len(out) >= 50_000:
                yield framed()
        yield framed()

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.select("conv_id", "place", "symbol", "bytes").mapInPandas(run, _PARTS)


def _subtree_sums(shared: DataFrame, written, heavy: int) -> DataFrame:
    """key with leaves and saved summed over its subtree, for key, up (the parent), leaves and saved."""
    state, number = shared, 0
    while not state.where("up IS NOT NULL").isEmpty():
        given = state.where("up IS NOT NULL").groupBy("up").agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        given = given.withColumnRenamed("up", "key")
        summed = state.join(given, "key", "left").select(
            "key", "up",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        jumps = state.select(F.col("key").alias("up"), F.col("up").alias("next"))
        summed = written(summed, f"summed-{number}")
        jumped = looked_up(summed, "up", jumps, heavy)
        state = written(jumped.select("key", F.col("next").alias("up"), "leaves", "saved"), f"sums-{number}")
        number += 1
    return state.select("key", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def _ends(last: DataFrame, settings: Settings) -> DataFrame:
    """key and the SHA-256 of the ids of the conversations that end there."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, first, ids = None, None, []

        def row() -> tuple:
            return key, first, ",".join(map(str, ids))

        for batch in batches:
            out = []
            for k, conv in zip(batch["key"], batch["conv_id"].tolist(), strict=True):
                if k != key or len(ids) >= settings.ends_per_piece:
                    if ids:
                        out.append(row())
                    key, first, ids = k, conv, []
                ids.append(conv)
            yield pd.DataFrame(out, columns=["key", "first", "ids"])
        if ids:
            yield pd.DataFrame([row()], columns=["key", "first", "ids"])

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, running = None, hashlib.sha256()
        for batch in batches:
            out = []
            for k, ids in zip(batch["key"], batch["ids"], strict=True):
                if k != key:
                    if key is not None:
                        out.append((key, running.hexdigest()))
                    key, running = k, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, running.hexdigest())], columns=["key", "ends_sha256"])

    sorted_ends = last.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = sorted_ends.select("key", "conv_id").mapInPandas(pieces, "key binary, first long, ids string")
    dealt = joined.repartition("key").sortWithinPartitions("key", "first").select("key", "ids")
    return dealt.mapInPandas(digests, "key binary, ends_sha256 string")


def prefix_nodes(turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per node: key (digest of its turns), conv_id (least member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``turns`` has conv_id, place, symbol and bytes as ``turn_table`` gives them; a row with place 0
    stands for a conversation that may have no turn.
    """
    spark = turns.sparkSession
    path = scratch_path(spark, "trie")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    parts = written(_parts(turns, settings), "parts")
    last = parts.where("conv_id IS NOT NULL").select("key", "conv_id")
    nodes = written(
        parts.where("conv_id IS NULL").groupBy("key").agg(
            F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("bytes").alias("bytes"),
            F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"),
        ),
        "nodes",
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single")
    )
    counted = written(
        nodes.join(children, "key", "left").na.fill(0, ["n_children", "single"]), "counted"
    )
    several = counted.where("n_convs > 1")
    shared = several.select(
        "key", F.col("parent").alias("up"),
        (F.col("single") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    sums = written(_subtree_sums(shared, written, settings.heavy), "sums")
    ends = written(_ends(last, settings), "ends")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = looked_up(counted, "parent", above, settings.heavy)
    found = found.join(sums, "key", "left").join(ends, "key", "left")
    return found.select(
        "key", "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def rebuilt(turns: DataFrame, most: int = 8, group: int = 5) -> DataFrame:
    """Turns of every conversation c with the first h turns of c - c % ``group`` before its own after the
    first h; h is the crc32 of c in decimal, modulo ``most`` + 1.

    Places are those of the turns in their own conversations, so they may leave gaps; place 0 stands
    for the conversation.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    names = turns.select("conv_id").distinct()
    heads = turns.where(F.col("place") <= most).withColumnRenamed("conv_id", "base")
    wanted = names.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), shared.alias("h"))
    first = wanted.join(heads, "base").where("place <= h").select("conv_id", "place", "symbol", "bytes")
    own = turns.where(F.col("place") > shared)
    empty = names.select(
        "conv_id", F.lit(0).alias("place"), F.lit(None).cast("binary").alias("symbol"),
        F.lit(0).cast("long").alias("bytes"),
    )
    return first.unionByName(own).unionByName(empty)
