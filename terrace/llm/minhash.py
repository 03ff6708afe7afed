"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact checks.

A document's set holds its distinct word shingles.  Two documents are linked when the sets'
similarity reaches the threshold; a component is what links reach.

1. Each row gets a digest of its word sequence, its band keys and one byte per hash
   function.  Rows of one word sequence collapse into one node by a partial aggregate, so
   a third of all rows being copies costs no more than one.
2. Nodes are grouped by band key.  Groups with the same members in several bands are looked at
   once.  A group of any size is cut into tiles of two blocks of bounded size; every pair of the
   group meets in one tile, and no pair becomes a row.
3. Within a tile each node meets the others that share no earlier band with it.  Signature bytes are
   compared batch by batch; a pair goes when the posterior probability of reaching the threshold
   falls below ``miss``.  What survives and is not connected yet is checked on full shingle sets.
   A tile returns the links of a spanning forest.
4. Components of these links give every row its component.

With 24 bands of 5 hashes a pair at similarity 0.85 is no candidate with probability 8e-7.

Rows without text or words have no shingles and stand alone.  Rows without doc_id are linked as all others,
but a component is named by one only if it has no other rows.  Repeated rows share a component.  Rows
of one doc_id with different texts are separate documents.  Texts are looked at whole, whatever their
length.  Other columns are not read, whatever their names.  An empty table has an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.components import connected_components
from terrace.llm.lookup import looked_up
from terrace.llm.tiles import Forest, Links, Tile, links, tile
from terrace.session import scratch_path

_CACHED_WORDS = 100_000
_CHUNK = 4096
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(29)


@dataclass(frozen=True)
class Settings:
    """Shingle size, threshold (percent) and search parameters."""

    words: int = 3
    percent: int = 85
    bands: int = 24
    rows: int = 5
    step: int = 24
    miss: float = 1e-7
    block: int = 512

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _SHIFT)) * _M2
    return values ^ (values >> _SHIFT)


class Sketcher:
    """Words, shingle sets and signatures of texts."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self._hashes = _WordHashes()
        seeded = np.random.default_rng(20)
        self._factors = seeded.integers(1, 1 << 32, settings.hashes, dtype=np.uint32) | np.uint32(1)

    @staticmethod
    def words(text: str) -> list[bytes]:
        """Lower-cased (A-Z) words between ASCII white space."""
        return text.encode().lower().split()

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct 64-bit shingle hashes."""
        if not words:
            return np.zeros(0, dtype=np.uint64)
        each = np.fromiter(map(self._hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        size = min(self.settings.words, len(words))
        count = len(words) - size + 1
        value = np.full(count, size, dtype=np.uint64)
        for i in range(size):
            value = value * _M1 + each[i : i + count]
        return np.unique(_mixed(value))

    def signature(self, shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Band keys, and one byte for each hash function."""
        low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.settings.hashes, 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(low), _CHUNK):
            values = np.multiply.outer(self._factors, low[at : at + _CHUNK])
            values += high[at : at + _CHUNK]
            np.minimum(least, values.min(axis=1), out=least)
        wide = _mixed(least.astype(np.uint64) + _M1)
        keys = np.arange(self.settings.bands, dtype=np.uint64)
        for part in wide.reshape(self.settings.bands, self.settings.rows).T:
            keys = _mixed(keys * _M1 + part)
        return keys.view(np.int64), wide.astype(np.uint8).tobytes()


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """(hashes compared, matching bytes needed to go on), batch by batch.

    With a uniform prior on the similarity, m of n equal bytes leave the posterior probability
    P(similarity >= t) = P(Binomial(n + 1, t) <= m), where t counts bytes equal by chance.
    """
    similar = settings.percent / 100
    t = similar + (1 - similar) / 256
    bounds = []
    for n in range(settings.step, settings.hashes + 1, settings.step):
        below, m = 0.0, -1
        while below < settings.miss:
            m += 1
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        bounds.append((n, m))
    return bounds


def sketch(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, ``same`` (digest of the word sequence), n_shingles, bands, bytes; one row per row."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketcher = Sketcher(settings)
        for batch in batches:
            same, counts, bands, signs = [], [], [], []
            for text in batch["text"]:
                words = sketcher.words(text)
                shingles = sketcher.shingles(words)
                counts.append(len(shingles))
                keys, sign = sketcher.signature(shingles) if words else (None, None)
                same.append(hashlib.md5(b" ".join(words)).digest() if words else None)
                bands.append(keys)
                signs.append(sign)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "text_md5": batch["text_md5"],
                    "same": same,
                    "n_shingles": counts,
                    "bands": bands,
                    "sign": signs,
                }
            )

    text = F.coalesce("text", F.lit(""))
    # a nullable long would turn into double in pandas
    named = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), text.alias("text"), F.md5(text).alias("text_md5")
    )
    schema = (
        "doc_id string, text_md5 string, same binary, n_shingles long, bands array<long>, sign binary"
    )
    return named.mapInPandas(rows, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def _nodes(sketches: DataFrame) -> DataFrame:
    """One row for each word sequence, named by its first row (see ``near_duplicates``)."""
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_md5")
    return (
        sketches.where("n_shingles > 0")
        .groupBy("same")
        .agg(F.min(place).alias("first"), F.first("bands").alias("bands"), F.first("sign").alias("sign"))
        .select(F.monotonically_increasing_id().alias("node"), "same", "first", "bands", "sign")
    )


def _links_of_tile(tile: Tile, sketcher: Sketcher, bounds: list[tuple[int, int]]) -> Links:
    settings = sketcher.settings
    size, band = len(tile["node"]), int(tile["band"][0])
    apart = tile["i"][0] != tile["j"][0]
    block = tile["block"]
    bands = np.stack(tile["bands"])[:, :band]
    signs = np.frombuffer(b"".join(tile["sign"]), dtype=np.uint8).reshape(size, -1)
    sets: dict[int, np.ndarray] = {}

    def shingles(x: int) -> np.ndarray:
        if x not in sets:
            sets[x] = sketcher.shingles(sketcher.words(tile["text"][x]))
        return sets[x]

    forest, found = Forest(size), []
    for x in range(size - 1):
        met = np.arange(x + 1, size)
        if apart:
            met = met[block[met] != block[x]]
        if band and len(met):
            met = met[~(bands[met] == bands[x]).any(axis=1)]  # they met in an earlier band
        equal, done = np.zeros(len(met), dtype=np.int64), 0
        for n, needed in bounds:
            if not len(met):
                break
            equal = equal + (signs[met, done:n] == signs[x, done:n]).sum(axis=1)
            met, equal, done = met[equal >= needed], equal[equal >= needed], n
        root = forest.root(x)
        met = [y for y in met.tolist() if forest.root(y) != root]
        if not met:
            continue
        own, theirs = shingles(x), [shingles(y) for y in met]
        sizes = np.array([len(t) for t in theirs])
        every = np.concatenate(theirs)
        place = np.minimum(np.searchsorted(own, every), len(own) - 1)
        ends = np.cumsum(sizes)
        shared = np.add.reduceat((own[place] == every).astype(np.int64), ends - sizes)
        linked = 100 * shared >= settings.percent * (len(own) + sizes - shared)
        for y in np.flatnonzero(linked).tolist():
            if forest.join(x, met[y]):
                found.append((int(tile["node"][x]), int(tile["node"][met[y]])))
    return found


def _opened(settings: Settings) -> Callable[[Tile], Links]:
    sketcher, bounds = Sketcher(settings), least_matches(settings)
    return lambda tile: _links_of_tile(tile, sketcher, bounds)


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, text_md5, n_shingles, component_id, stays_id, stays_md5 and kept for every row of ``docs``.

    The first row of a component has the least doc_id (null comes last) and then the least md5 of its
    text: ``stays_id`` and ``stays_md5``; ``component_id`` is that doc_id.  Rows without words are
    components of their own.  ``kept`` says that a row has the doc_id of its component, or, in a
    component without any, the text of its first row.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "minhash")
    sketch(docs, settings).write.parquet(f"{path}/sketches")
    sketches = spark.read.parquet(f"{path}/sketches")
    _nodes(sketches).write.parquet(f"{path}/nodes")
    nodes = spark.read.parquet(f"{path}/nodes")

    members = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    tile(members, settings.block).write.parquet(f"{path}/tiles")
    tiles = spark.read.parquet(f"{path}/tiles")
    needed = nodes.join(tiles.select("node").distinct(), "node", "left_semi")
    needed = needed.select("node", "first.text_md5", "bands", "sign")
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.md5(text).alias("text_md5"), text.alias("text"))
    # equal texts go before the shuffle
    known = texts.dropDuplicates(["text_md5"]).join(needed, "text_md5").drop("text_md5")
    found = links(tiles.join(known, "node"), ["text", "bands", "sign"], lambda: _opened(settings))
    found.write.parquet(f"{path}/links")

    roots = connected_components(spark.read.parquet(f"{path}/links"))
    rooted = nodes.select("node", "same", "first").join(roots, "node")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    linked = rooted.join(least, "root").select("same", "least")
    named = nodes.select("same", "first").join(linked, "same", "left").select(
        "same", F.coalesce("least", "first").alias("stays")
    )
    named.write.parquet(f"{path}/named")
    rows = sketches.select("doc_id", "text_md5", "n_shingles", "same")
    met = looked_up(rows, "same", spark.read.parquet(f"{path}/named"))
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_md5")
    stays = F.coalesce("stays", own)
    return met.select(
        "doc_id", "text_md5", "n_shingles",
        stays["doc_id"].alias("component_id"),
        stays["doc_id"].alias("stays_id"),
        stays["text_md5"].alias("stays_md5"),
        F.when(stays["unnamed"], F.col("text_md5") == stays["text_md5"])
        .otherwise(F.coalesce(F.col("doc_id") == stays["doc_id"], F.lit(False)))
        .alias("kept"),
    )
