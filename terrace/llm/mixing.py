"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is what brings its rows to its share of the target.  Every
document draws its number of copies from the Poisson distribution of that mean: a hash of seed and
doc_id is a uniform number, and the distribution is inverted at it.  The same seed gives the same
copies on any cluster.  Copies are then ordered by a hash over all tasks.

A mean over ``_WIDEST`` is drawn as a sum of equal smaller ones.  All of it are column
expressions; the only shuffles are the count of each source and the last sort.

A null source is a source of its own.  Without doc_id the hash is taken over the text, so
repeated rows get the same number of copies; a null text is kept as null.  Columns named
copy or mix_key are replaced.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDEST = 256.0
_BROADCAST_SOURCES = 2_000
_CUMULATED = "struct<p:double,c:double,all:array<double>>"


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from a hash."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substr(digest, F.lit(1), F.lit(13)), 16, 10).cast("double") / F.lit(2.0**52)


def _cumulated(mean: Column) -> Column:
    """Poisson probabilities of at most 0, 1, 2 ... up to where the rest is below 1e-16."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(state["all"], F.array(c)).alias("all"))

    none = F.exp(-mean)
    begin = F.struct(none.alias("p"), none.alias("c"), F.array(none).alias("all")).cast(_CUMULATED)
    return F.aggregate(F.sequence(F.lit(1), last), begin, add, lambda state: state["all"])


def rates(
    docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.7, size: float = 1.0
) -> tuple[DataFrame, int]:
    """source, n and rate of each source, and the number of sources.

    ``weights`` gives the share of each source (others get none).  Without it a source weighs
    its row count to the ``power``.  ``size`` is the target's row count over the input's.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(power))
    else:
        weight = F.lit(0.0)
        for source, share in weights.items():
            weight = F.when(F.col("source") == source, F.lit(float(share))).otherwise(weight)
    weighed = counts.withColumn("weight", weight)
    total = weighed.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.count("*").alias("k")).first()
    if not total["weight"]:
        return weighed.select("source", "n", F.lit(0.0).alias("rate")), total["k"]
    rate = F.lit(total["n"] * float(size)) * F.col("weight") / F.lit(total["weight"]) / F.col("n")
    return weighed.select("source", "n", rate.alias("rate")), total["k"]


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    power: float = 0.7,
    size: float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """The columns of ``docs`` with copy (from 1) and mix_key, one row for each copy, ordered by mix_key."""
    rated, sources = rates(docs, weights, power, size)
    draws = F.greatest(F.ceil(F.col("rate") / _WIDEST), F.lit(1)).cast("int")
    drawn = rated.select(
        F.col("source").alias("of"), draws.alias("draws"), _cumulated(F.col("rate") / draws).alias("below")
    )
    if sources <= _BROADCAST_SOURCES:
        drawn = F.broadcast(drawn)  # counted above; at most a few kilobytes each
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))
    packed = docs.select(F.struct("*").alias("doc"), F.col("source").alias("from"), key.alias("key"))
    met = packed.join(drawn, packed["from"].eqNullSafe(drawn["of"]))

    def draw(j: Column) -> Column:
        u = _uniform(F.lit(seed), F.col("key"), j)
        return F.size(F.filter("below", lambda c: c <= u))

    copies = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col("draws")), draw), F.lit(0), lambda a, b: a + b
    )
    counted = met.select("doc", "key", copies.alias("copies")).where("copies > 0")
    exploded = counted.select(
        "doc", "key", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    )
    mix_key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col("key"), F.col("copy")))
    kept = [F.col("doc")[c].alias(c) for c in docs.columns if c.lower() not in ("copy", "mix_key")]
    # the seeded number parts repeated rows, whose keys are equal
    return exploded.select(*kept, "copy", mix_key.alias("mix_key")).orderBy("mix_key", F.rand(seed))
