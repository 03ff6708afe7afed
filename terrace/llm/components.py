"""Connected components of an edge table by random contraction.

Each round gives every node the least of its neighbours and itself under a fresh order (the id
exclusive-or a seeded number), renames the ends of all edges and drops loops and repeats.
Rounds are written to the shared folder, so lineage stays short and lost executors cost one
round.  A hub of any degree is a partial aggregate and a join that AQE may split.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.session import scratch_path


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (one node of its component) for every node that has an edge."""
    spark = edges.sparkSession
    path = scratch_path(spark, "components")
    order = random.Random(0)

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    def plain(one: str, two: str, frame: DataFrame) -> DataFrame:
        low, high = F.least(one, two), F.greatest(one, two)
        return frame.select(low.alias("a"), high.alias("b")).where("a < b").distinct()

    edges = written(plain(a, b, edges), "edges-0")
    parents = []
    while not edges.isEmpty():
        mask = F.lit(order.getrandbits(63))
        both = edges.union(edges.select("b", "a"))
        least = F.least(F.min(F.col("b").bitwiseXOR(mask)), F.col("a").bitwiseXOR(mask))
        parent = both.groupBy("a").agg(least.bitwiseXOR(mask).alias("parent"))
        parent = written(parent.withColumnRenamed("a", "node"), f"parents-{len(parents)}")
        parents.append(parent)
        one = parent.select(F.col("node").alias("a"), F.col("parent").alias("one"))
        two = parent.select(F.col("node").alias("b"), F.col("parent").alias("two"))
        renamed = edges.join(one, "a").join(two, "b")
        edges = written(plain("one", "two", renamed), f"edges-{len(parents)}")
    if not parents:
        return spark.createDataFrame([], "node long, root long")
    roots = parents[0].withColumnRenamed("parent", "root")
    for parent in parents[1:]:
        step = parent.select(F.col("node").alias("root"), "parent")
        roots = roots.join(step, "root", "left").select(
            "node", F.coalesce("parent", "root").alias("root")
        )
    return roots
