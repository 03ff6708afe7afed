"""Near copies among vectors by an epsilon grid order join.

1. Equal vectors become one node with a weight, by a partial aggregate; nodes are scaled to length 1.  A cosine
   of at least ``similar`` is a distance of at most epsilon = sqrt(2 - 2 similar).
2. Nodes are turned to the principal axes of all of them (moments of fixed size reach the driver) and
   sorted by their grid cells, of width epsilon and then a quarter of it, on the leading axes.  The sequence is
   cut into intervals of ``interval`` nodes, whatever its partitions are.
3. Intervals are joined from the top: a pair of groups of intervals is replaced by the pairs of
   their members whose boxes, on the leading axes, are not farther apart than epsilon.  Only
   names and boxes take part in this, a level per round, until pairs of intervals are left.
4. A pair of intervals is a task's unit: it is split again and again at the longer side, and pairs of parts
   are left out when their boxes or balls are provably too far apart.  Small parts are multiplied in
   double precision.  Where balls are provably near, all of their nodes are linked without it.
5. A task returns how many vectors each node is linked with and a spanning forest of its links, never pairs.
   Components of the forests are found by contraction.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing; shorter ones count as
filled up with zeros.  Rows that repeat a vec_id are vectors of their own.  Rows without vec_id are linked
too; a component is named by the least vec_id in it, null if it has none.  ``kept`` says that a row's
vec_id is that name (null equals null).  Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.components import connected_components
from terrace.session import scratch_path

_MARGIN = 1e-9
_FAN = 16


@dataclass(frozen=True)
class Settings:
    similar: float = 0.9
    axes: int = 8
    interval: int = 8192
    leaf: int = 256
    heavy: int = 1000

    @property
    def epsilon(self) -> float:
        return float(np.sqrt(2 - 2 * self.similar))


def _usable() -> Column:
    huge = F.lit(float("inf"))
    finite = F.forall(
        "embedding",
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < huge), F.lit(False)),
    )
    return F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _units(values, width: int) -> np.ndarray:
    """Rows of length 1; divided by their largest component first, as squares may not fit."""
    out = np.zeros((len(values), width))
    for i, value in enumerate(values):
        out[i, : len(value)] = value
    return _scaled(out)


def _scaled(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _principal_axes(nodes: DataFrame, width: int, axes: int) -> np.ndarray:
    """The leading eigenvectors of the covariance, as columns."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if len(batch):
                rows = np.column_stack([_units(batch["embedding"], width), np.ones(len(batch))])
                total += rows.T @ rows
        yield pd.DataFrame({"i": np.arange(width + 1), "row": list(total)})

    rows = nodes.select("embedding").mapInPandas(moments, "i int, row array<double>")
    cells = rows.select("i", F.posexplode("row").alias("j", "x"))
    summed = cells.groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    whole = np.zeros((width + 1, width + 1))
    whole[summed["i"], summed["j"]] = summed["x"]
    count = max(whole[-1, -1], 1.0)
    mean = whole[-1, :-1] / count
    values, vectors = np.linalg.eigh(whole[:-1, :-1] / count - np.outer(mean, mean))
    return vectors[:, ::-1][:, :axes].copy()


def _in_grid_order(nodes: DataFrame, basis: np.ndarray, settings: Settings) -> DataFrame:
    """node, weight, embedding and x (the leading coordinates), sorted by cells."""
    width = basis.shape[0]

    def turn(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series(list(_units(values, width) @ basis), dtype=object)

    def cells(size: float) -> Column:
        return F.transform("x", lambda v: F.floor(v / size))

    x = F.pandas_udf(turn, "array<double>")("embedding").alias("x")
    placed = nodes.select("node", "weight", "embedding", x).select(
        "*", cells(settings.epsilon).alias("cell"), cells(settings.epsilon / 4).alias("fine")
    )
    order = ["cell", "fine", "node"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.drop("cell", "fine").withColumn("at", F.monotonically_increasing_id())


def _intervals(ordered: DataFrame, width: int, element: str, settings: Settings) -> DataFrame:
    """interval, low and high (its box) and its nodes packed."""
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    # one row for each written partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    placed = ordered.withColumn("part", part).join(F.broadcast(starts), "part")
    number = F.floor((F.col("start") + place) / settings.interval).cast("long")
    kind = np.float32 if element == "float" else np.float64

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        vectors = np.zeros((len(rows), width), dtype=kind)
        for i, value in enumerate(rows["embedding"]):
            vectors[i, : len(value)] = value
        x = np.stack(rows["x"].to_list())
        packed = [rows[c].to_numpy(np.int64).tobytes() for c in ("node", "weight")]
        return pd.DataFrame(
            [(key[0], x.min(axis=0), x.max(axis=0), *packed, x.tobytes(), vectors.tobytes())],
            columns=["interval", "low", "high", "nodes", "weights", "x", "vectors"],
        )

    return (
        placed.select(number.alias("interval"), "at", "node", "weight", "x", "embedding")
        .groupBy("interval")
        .applyInPandas(
            pack,
            "interval long, low array<double>, high array<double>, nodes binary, weights binary, "
            "x binary, vectors binary",
        )
    )


def _near_intervals(boxes: DataFrame, count: int, axes: int, settings: Settings, written) -> DataFrame:
    """a and b: pairs of intervals (a up to b) whose boxes are within epsilon of each other."""
    levels = [boxes]
    size = count
    while size > 1:
        size = -(-size // _FAN)
        extremes = [f(F.col(c)[n]).alias(f"{c}{n}") for c, f in (("low", F.min), ("high", F.max)) for n in range(axes)]
        above = levels[-1].groupBy(F.floor(F.col("id") / _FAN).cast("long").alias("id")).agg(*extremes)
        levels.append(
            above.select("id", *(F.array(*(f"{c}{n}" for n in range(axes))).alias(c) for c in ("low", "high")))
        )
    found = levels[-1].select(F.col("id").alias("a"), F.col("id").alias("b"))
    for level in reversed(range(len(levels) - 1)):
        child = levels[level].withColumn("up", F.floor(F.col("id") / _FAN).cast("long"))
        one = child.select(*(F.col(c).alias(f"{c}_a") for c in child.columns))
        two = child.select(*(F.col(c).alias(f"{c}_b") for c in child.columns))
        gaps = [
            F.greatest(F.col("low_a")[n] - F.col("high_b")[n], F.col("low_b")[n] - F.col("high_a")[n], F.lit(0.0))
            for n in range(axes)
        ]
        apart = reduce(lambda s, g: s + g * g, gaps, F.lit(0.0))
        met = found.join(one, F.col("a") == F.col("up_a")).join(two, F.col("b") == F.col("up_b"))
        met = met.where((F.col("id_a") <= F.col("id_b")) & (apart <= settings.epsilon**2 + _MARGIN))
        found = written(met.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), f"pairs-{level}")
    return found


class _Side:
    """The nodes of an interval in a task."""

    def __init__(self, nodes: bytes, weights: bytes, x: bytes, vectors: bytes, width: int, axes: int):
        self.nodes, self.weights = (np.frombuffer(b, dtype=np.int64) for b in (nodes, weights))
        size = len(self.nodes)
        self.x = np.frombuffer(x, dtype=np.float64).reshape(size, axes)
        kind = np.float32 if len(vectors) == 4 * size * width else np.float64
        self.units = _scaled(np.frombuffer(vectors, dtype=kind).reshape(size, width).astype(np.float64))
        self.linked = np.zeros(size, dtype=np.int64)
        self._shapes: dict[tuple[int, int], tuple] = {}

    def shape(self, part: tuple[int, int]) -> tuple:
        """Box, centre and radius of a part."""
        if part not in self._shapes:
            x, units = self.x[slice(*part)], self.units[slice(*part)]
            centre = units.mean(axis=0)
            radius = float(np.sqrt(((units - centre) ** 2).sum(axis=1).max()))
            self._shapes[part] = (x.min(axis=0), x.max(axis=0), centre, radius)
        return self._shapes[part]


class _Join:
    """The links between two intervals (or within one)."""

    def __init__(self, a: _Side, b: _Side, settings: Settings):
        self.a, self.b, self.settings, self.same = a, b, settings, a is b
        self.offset = 0 if self.same else len(a.nodes)
        self.up = np.arange(self.offset + len(b.nodes))
        self.links: list[tuple[int, int]] = []

    def run(self) -> None:
        parts = [((0, len(self.a.nodes)), (0, len(self.b.nodes)))]
        while parts:
            one, two = parts.pop()
            near = self._near(one, two)
            if near is False:
                continue
            within = self.same and one == two
            if near or (one[1] - one[0] <= self.settings.leaf and two[1] - two[0] <= self.settings.leaf):
                self._link(one, two, within, all_of_them=bool(near))
            elif within:
                low, high = _halves(one)
                parts += [(low, low), (low, high), (high, high)]
            elif one[1] - one[0] >= two[1] - two[0]:
                parts += [(half, two) for half in _halves(one)]
            else:
                parts += [(one, half) for half in _halves(two)]

    def _near(self, one: tuple, two: tuple) -> bool | None:
        """False if no two nodes of the parts can be linked, True if all must be."""
        low_a, high_a, centre_a, radius_a = self.a.shape(one)
        low_b, high_b, centre_b, radius_b = self.b.shape(two)
        epsilon = self.settings.epsilon
        gap = np.maximum(np.maximum(low_a - high_b, low_b - high_a), 0.0)
        if gap @ gap > epsilon**2 + _MARGIN:
            return False
        apart = float(np.sqrt(((centre_a - centre_b) ** 2).sum()))
        if apart - radius_a - radius_b > epsilon + _MARGIN:
            return False
        return True if apart + radius_a + radius_b < epsilon - _MARGIN else None

    def _link(self, one: tuple, two: tuple, within: bool, all_of_them: bool) -> None:
        a, b = slice(*one), slice(*two)
        sizes = one[1] - one[0], two[1] - two[0]
        if all_of_them:
            # every node with the other part's first, and that with this part's first
            weight_a, weight_b = self.a.weights[a], self.b.weights[b]
            self.a.linked[a] += weight_b.sum() - (weight_a if within else 0)
            if not within:
                self.b.linked[b] += weight_a.sum()
            rows = np.concatenate([np.arange(sizes[0]), np.zeros(sizes[1], dtype=np.int64)])
            columns = np.concatenate([np.zeros(sizes[0], dtype=np.int64), np.arange(sizes[1])])
        else:
            linked = self.a.units[a] @ self.b.units[b].T >= self.settings.similar
            if within:
                np.fill_diagonal(linked, False)
            self.a.linked[a] += linked @ self.b.weights[b]
            if not within:
                self.b.linked[b] += self.a.weights[a] @ linked
            rows, columns = np.nonzero(linked)
        self._connect(rows + one[0], columns + two[0] + self.offset)

    def _connect(self, rows: np.ndarray, columns: np.ndarray) -> None:
        if not len(rows):
            return
        one, two = self._roots(rows), self._roots(columns)
        apart = one != two
        for x, y, i, j in zip(*(v[apart].tolist() for v in (one, two, rows, columns)), strict=True):
            x, y = self._root(x), self._root(y)
            if x != y:
                self.up[y] = x
                first = self.a.nodes[i]
                self.links.append((int(first), int(self.b.nodes[j - self.offset])))

    def _root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = int(self.up[x])
        return x

    def _roots(self, places: np.ndarray) -> np.ndarray:
        roots = self.up[places]
        while True:
            above = self.up[roots]
            if (above == roots).all():
                return roots
            roots = above


def _halves(part: tuple[int, int]) -> tuple:
    middle = (part[0] + part[1]) // 2
    return (part[0], middle), (middle, part[1])


def _joined(pairs: DataFrame, blocks: DataFrame, width: int, axes: int, settings: Settings) -> DataFrame:
    """a and b: links of a spanning forest; with null b, n: vectors that node a is linked with."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples(index=False):
                a = _Side(pair.nodes_a, pair.weights_a, pair.x_a, pair.vectors_a, width, axes)
                b = a
                if pair.a != pair.b:
                    b = _Side(pair.nodes_b, pair.weights_b, pair.x_b, pair.vectors_b, width, axes)
                join = _Join(a, b, settings)
                join.run()
                links = pd.DataFrame(join.links, columns=["a", "b"], dtype="Int64")
                sides = [a] if a is b else [a, b]
                counts = [
                    pd.DataFrame({"a": s.nodes[s.linked > 0], "n": s.linked[s.linked > 0]}) for s in sides
                ]
                found = pd.concat([links, *counts], ignore_index=True)
                yield found.reindex(columns=["a", "b", "n"]).astype("Int64")

    def named(side: str) -> DataFrame:
        packed = blocks.select("interval", "nodes", "weights", "x", "vectors")
        return packed.select(*(F.col(c).alias(f"{c}_{side}" if c != "interval" else side) for c in packed.columns))

    # each interval is the first of about half of its pairs
    turned = pairs.select(
        F.when((F.col("a") + F.col("b")) % 2 == 0, F.col("a")).otherwise(F.col("b")).alias("a"),
        F.when((F.col("a") + F.col("b")) % 2 == 0, F.col("b")).otherwise(F.col("a")).alias("b"),
    )
    return turned.join(named("a"), "a").join(named("b"), "b").mapInPandas(run, "a long, b long, n long")


def near_vectors(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    spark = table.sparkSession
    path = scratch_path(spark, "vectors")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    usable = rows.where(_usable())
    nodes = usable.groupBy("embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    size, width = nodes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not size:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    axes = min(settings.axes, width)
    basis = _principal_axes(nodes, width, axes)
    ordered = written(_in_grid_order(nodes, basis, settings), "ordered")
    element = table.schema["embedding"].dataType.elementType.simpleString()
    blocks = written(_intervals(ordered, width, element, settings), "intervals")
    boxes = blocks.select(F.col("interval").alias("id"), "low", "high")
    pairs = _near_intervals(boxes, -(-size // settings.interval), axes, settings, written)
    if size <= settings.interval:
        pairs = boxes.select(F.col("id").alias("a"), F.col("id").alias("b"))
    found = written(_joined(pairs, blocks, width, axes, settings), "links")

    others = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    rooted = nodes.select("node", "least").join(roots, "node")
    named = rooted.groupBy("root").agg(F.min("least").alias("name"))
    linked = rooted.join(named, "root").select("node", "name")
    result = (
        nodes.join(others, "node", "left").join(linked, "node", "left")
        .select(
            "embedding", "weight",
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("name", "least").alias("component_id"),
        )
    )
    result = written(result, "result")
    # a vector of very many rows stays where its rows are; there are fewer than ``heavy`` of these
    often = F.col("weight") > max(1, result.agg(F.sum("weight")).first()[0] // settings.heavy)
    few = F.broadcast(result.where(often).drop("weight").withColumn("often", F.lit(True)))
    marked = rows.join(few, "embedding", "left")
    hot = marked.where("often").drop("often", "embedding")
    rest = marked.where("often IS NULL").select("vec_id", "embedding")
    cold = rest.join(result.where(~often).drop("weight"), "embedding", "left").drop("embedding")
    alone = F.coalesce("n_links", F.lit(0)) == 0
    both = hot.unionByName(cold).select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
