"""Exact top-k inner products of a query set against all vectors.

Vectors become integers (floor of ``scale`` times each component) and are ordered by length,
longest first, in blocks of bounded size; queries likewise.

1. Rows turned into the eigenvectors of the vectors' second moments (their SVD basis) hold most of
   an inner product in the first dimensions.  The moments are summed over all vectors.
2. Every query meets the block of the longest vectors, which gives it a first k-th score.
3. A query block meets a vector block only if the product of its longest lengths can reach one of
   its k-th scores.  Within the pair, vectors are taken longest first; a product is computed only
   where the sum over the first turned dimensions plus the Cauchy-Schwarz bound of the rest
   (length times length) reaches the query's k-th score, and the scores rise as it goes on.
4. Pairs of blocks return k rows a query at most; the best k of these are the result.

Products are integers, computed exactly; bounds carry a margin for rounding.  Equal scores go
to the smaller vec_id.  Vectors that are null or hold null or non-finite components, or
whose vec_id is null, take no part; shorter ones count as filled up with zeros.  Rows that
repeat a vec_id are different rows: each is a candidate, and no query meets its own row.  Other
columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.session import scratch_path

_PACKED = "part int, place int, n int, longest double, rows binary, ids binary, vectors binary"
_EXACT_FLOAT = 2.0**53


@dataclass(frozen=True)
class Settings:
    k: int = 5
    scale: int = 256
    block: int = 4096
    queries: int = 1024
    step: int = 1024
    first: int = 16


def _integers(table: DataFrame, scale: int) -> DataFrame:
    """vec_id and v (array of long) of the rows that take part, with an id for each row."""
    huge = F.lit(float("inf"))
    fits = F.forall(
        "embedding",
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < huge), F.lit(False)),
    )
    good = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fits)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return good.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), whole.alias("v")
    )


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), dtype=np.int64)
    for i, value in enumerate(values):
        out[i, : len(value)] = value
    return out


def _basis(vectors: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the second moments, largest first; width x width numbers reach the driver."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            matrix = _matrix(batch["v"], width).astype(np.float64)
            total += matrix.T @ matrix
        yield pd.DataFrame({"i": np.arange(width), "row": list(total)})

    rows = vectors.select("v").mapInPandas(moments, "i int, row array<double>")
    cells = rows.select("i", F.posexplode("row").alias("j", "x"))
    summed = cells.groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    whole = np.zeros((width, width))
    whole[summed["i"], summed["j"]] = summed["x"]
    return np.linalg.eigh(whole)[1][:, ::-1].copy()


def _packed(vectors: DataFrame, width: int, size: int) -> DataFrame:
    """Blocks of up to ``size`` vectors, longest first."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, place = TaskContext.get().partitionId(), 0
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch])
            while len(held) >= size:
                yield block(held.iloc[:size], part, place)
                held, place = held.iloc[size:], place + 1
        if held is not None and len(held):
            yield block(held, part, place)

    def block(rows: pd.DataFrame, part: int, place: int) -> pd.DataFrame:
        packed = [rows[c].to_numpy(np.int64).tobytes() for c in ("row", "vec_id")]
        vectors = _matrix(rows["v"], width).tobytes()
        longest = float(np.sqrt(rows["squares"].max()))
        return pd.DataFrame([(part, place, len(rows), longest, *packed, vectors)], columns=_names(_PACKED))

    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    measured = vectors.withColumn("squares", squares)
    order = [F.desc("squares"), F.asc("vec_id"), F.asc("row")]
    dealt = measured.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInPandas(pack, _PACKED)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of rows: as doubles while these hold them, else in whole numbers."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0))
    if bound * queries.shape[1] < _EXACT_FLOAT:
        return queries.astype(np.float64) @ vectors.astype(np.float64).T
    return queries.astype(object) @ vectors.astype(object).T


class _Best:
    """The best k of each query so far: scores, vec_ids and rows."""

    def __init__(self, k: int, floors: np.ndarray):
        self.k = k
        self.found: list[list[tuple[int, int]]] = [[] for _ in floors]
        self.floors = floors.copy()  # what a score must reach

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        both = self.found[query] + [(-int(s), int(i)) for s, i in zip(scores, ids, strict=True)]
        both.sort()
        self.found[query] = both[: self.k]
        if len(both) >= self.k:
            self.floors[query] = max(self.floors[query], -both[self.k - 1][0])


def _meet(q: dict, v: dict, floors: np.ndarray, basis: np.ndarray, settings: Settings) -> _Best:
    """The best of one vector block for each query of one query block."""
    best = _Best(settings.k, floors)
    first = min(settings.first, basis.shape[0])
    turned_q, turned_v = q["vectors"] @ basis, v["vectors"] @ basis
    rest_q = np.sqrt((turned_q[:, first:] ** 2).sum(axis=1))
    rest_v = np.sqrt((turned_v[:, first:] ** 2).sum(axis=1))
    length_q = np.sqrt((turned_q**2).sum(axis=1))
    length_v = np.sqrt((turned_v**2).sum(axis=1))
    for at in range(0, len(length_v), settings.step):
        part = slice(at, at + settings.step)
        most = float(length_v[part].max(initial=0))
        slack = 1e-9 * length_q * most + 1e-6
        open_queries = np.flatnonzero(length_q * most + slack >= best.floors)
        if not len(open_queries):
            continue
        bound = turned_q[open_queries, :first] @ turned_v[part, :first].T
        bound += rest_q[open_queries, None] * rest_v[None, part]
        reach = bound + slack[open_queries, None] >= best.floors[open_queries, None]
        own = q["rows"][open_queries, None] == v["rows"][None, part]
        reach &= ~own
        some = np.flatnonzero(reach.any(axis=0))
        if not len(some):
            continue
        scores = _products(q["vectors"][open_queries], v["vectors"][part][some])
        ids = v["ids"][part][some]
        for i, query in enumerate(open_queries.tolist()):
            near = np.flatnonzero(reach[i, some])
            if len(near) > settings.k:
                kth = np.partition(scores[i, near], len(near) - settings.k)[len(near) - settings.k]
                near = near[scores[i, near] >= kth]
                if len(near) > settings.k:  # ties: the smaller ids
                    near = near[np.lexsort((ids[near], -scores[i, near]))[: settings.k]]
            best.add(query, scores[i, near], ids[near])
    return best


def _opened(block, width: int, prefix: str) -> dict:
    return {
        "rows": np.frombuffer(getattr(block, f"{prefix}rows"), dtype=np.int64),
        "ids": np.frombuffer(getattr(block, f"{prefix}ids"), dtype=np.int64),
        "vectors": np.frombuffer(getattr(block, f"{prefix}vectors"), dtype=np.int64).reshape(-1, width),
    }


def _met(pairs: DataFrame, basis: np.ndarray, settings: Settings, floors: bool) -> DataFrame:
    """query row and id with its best vectors, for each pair of blocks."""
    width = basis.shape[0]

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples(index=False):
                q, v = _opened(pair, width, "q_"), _opened(pair, width, "")
                least = np.full(len(q["ids"]), -np.inf)
                if floors and pair.q_floors is not None:
                    least = np.frombuffer(pair.q_floors, dtype=np.float64)
                best = _meet(q, v, least, basis, settings)
                out = [
                    (int(q["rows"][i]), int(q["ids"][i]), vec_id, -score)
                    for i, found in enumerate(best.found)
                    for score, vec_id in found
                ]
                yield pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"], dtype="int64")

    return pairs.mapInPandas(meet, "query_row long, query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(table: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score: the best ``k`` vectors for every row that ``is_query`` holds for."""
    spark = table.sparkSession
    path = scratch_path(spark, "products")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    vectors = written(_integers(table, settings.scale), "vectors")
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    basis = _basis(vectors, width)
    blocks = written(_packed(vectors, width, settings.block), "blocks")
    queries = written(_packed(vectors.where(is_query), width, settings.queries), "queries")

    def named(frame: DataFrame) -> DataFrame:
        return frame.select(*(F.col(c).alias(f"q_{c}") for c in frame.columns))

    # one block: the longest vectors
    head = blocks.orderBy(F.desc("longest"), "part", "place").limit(1)
    started = written(
        _met(named(queries).join(F.broadcast(head)), basis, settings, floors=False), "started"
    )
    kth = _ranked(started, settings.k).where(F.col("rank") == settings.k)
    kth = kth.select("query_row", F.col("score").cast("double").alias("floor"))

    # floors of each query block, in its order
    order = queries.select(
        "part", "place", F.posexplode(_longs("rows", F.col("n"))).alias("at", "query_row")
    )
    reached = order.join(kth, "query_row", "left")
    floors = reached.groupBy("part", "place").agg(
        F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("least"),
        F.array_sort(F.collect_list(F.struct("at", "floor"))).alias("floors"),
    )
    floors = written(_floor_bytes(floors), "floors")
    asked = queries.join(floors, ["part", "place"])

    lengths = asked.select("part", "place", "longest", "least")
    # pairs of block names; the blocks follow by key
    pairs = (
        named(lengths)
        .join(blocks.select("part", "place", "longest").hint("shuffle_replicate_nl"))
        .where("q_longest * longest * (1 + 1e-9) + 1e-6 >= q_least")
        .select("q_part", "q_place", "part", "place")
    )
    pairs = pairs.join(blocks, ["part", "place"]).join(named(asked), ["q_part", "q_place"])
    return _ranked(_met(pairs, basis, settings, floors=True), settings.k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def _longs(column: str, count: Column) -> Column:
    """The little-endian longs packed in a binary column."""
    text = F.hex(F.col(column))

    def one(i: Column) -> Column:
        cell = F.substr(text, i * 16 + 1, F.lit(16))
        return F.conv(F.concat(*(F.substr(cell, F.lit(15 - 2 * b), F.lit(2)) for b in range(8))), 16, -10)

    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: one(i).cast("long"))


def _floor_bytes(floors: DataFrame) -> DataFrame:
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = [
                np.array([-np.inf if f is None else f for f in row], dtype=np.float64).tobytes()
                for row in batch["floors"]
            ]
            yield pd.DataFrame(
                {"part": batch["part"], "place": batch["place"], "least": batch["least"], "floors": packed}
            )

    plain = floors.withColumn("floors", F.transform("floors", lambda f: f["floor"]))
    return plain.mapInPandas(pack, "part int, place int, least double, floors binary")
