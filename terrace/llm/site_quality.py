"""Quality by hierarchical empirical Bayes: a document's own evidence, its path and its host.

1. A logistic model over plain measures of a text (case, signs, repetition, shape) is fitted to a
   bounded sample of labelled documents: the ``sample`` labels whose doc_ids hash lowest.
2. Every document's probability is summed by host and path (grouped partial aggregates over all
   documents).  A beta prior over hosts is fitted by moments; a host's posterior rate shrinks to
   it, and a path's posterior rate shrinks to its host's, by the strength that the spread of paths
   within hosts shows.  Few documents stay near the prior, many speak for themselves.
3. A document's log-odds are its own plus ``weight`` times those of its path against the
   global rate, with its own share taken out of the path first.

A document is rejected when the probability falls below ``least``.  Null hosts and paths are groups
of their own.  Null and empty texts hold no evidence against them: they count as the global rate and
are kept.  Without labels of both kinds all documents are kept.  Repeated rows get equal results.
Very long texts are measured whole.  Other columns, whatever their names, come back in ``doc``; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import scratch_path

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGITS = bytes(range(0x30, 0x3A))
_USUAL = _UPPER + _LOWER + _DIGITS + b" \n\t.,;:'-" + bytes(range(0x80, 0x100))
_BROADCAST_PATHS = 50_000


@dataclass(frozen=True)
class Settings:
    sample: int = 10_000
    weight: float = 0.5
    least: float = 0.5
    strongest: float = 1000.0  # the most documents a prior may count for


def measures(text: str) -> list[float]:
    """What the classifier sees of a whole text."""
    raw, words, lines = text.encode(), text.split(), text.split("\n")
    size, count = len(raw) + 1, len(words) + 1
    without = lambda letters: (len(raw) - len(raw.translate(None, letters))) / size
    distinct = Counter(words)
    top = max(distinct.values(), default=0)
    letters = sum(map(len, words))
    return [
        math.log(count),
        without(_UPPER),
        without(_DIGITS),
        len(raw.translate(None, _USUAL)) / size,
        raw.count(b"|") / count,
        raw.count(b"!") / count,
        raw.count(b".") / count,
        raw.count(b",") / count,
        len(distinct) / count,
        len(distinct) / count**0.8,
        top / count,
        sum(map(eq, words, words[1:])) / count,
        sum(map(eq, words, words[2:])) / count,
        letters / count,
        max(map(len, words), default=0) / 20,
        len(set(lines)) / len(lines),
        len(lines) / count,
        sum(map(str.isupper, words)) / count,
    ]


class Model:
    """Logistic regression on standardised measures and their squares."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0, steps: int = 30):
        self.known = len(set(labels.tolist())) == 2
        if not self.known:
            return
        self._mean, self._spread = rows.mean(axis=0), rows.std(axis=0) + 1e-9
        x = self._terms(rows)
        keep = np.full(x.shape[1], ridge)
        keep[0] = 1e-6
        self._weights = np.zeros(x.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ self._weights, -30, 30)))
            slope = x.T @ (labels - p) - keep * self._weights
            curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
            step = np.linalg.solve(curve, slope)
            self._weights += step
            if np.abs(step).max() < 1e-6:
                break

    def _terms(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self._mean) / self._spread, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z, z * z / 4])

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.zeros(len(rows))
        # rounded, so that equal texts get equal numbers in batches of any size
        return np.round(np.clip(self._terms(rows) @ self._weights, -12, 12), 9)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings) -> Model:
    """The model of a bounded sample of labelled documents."""
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    sample = (
        usable.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "quality").limit(settings.sample)
    )

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [measures(t) for t in batch["text"]]
            yield pd.DataFrame({"quality": batch["quality"], "measures": rows})

    texts = docs.where(F.length("text") > 0).select("doc_id", "text")
    # one row for each sampled label
    met = texts.join(F.broadcast(sample), "doc_id").select("quality", "text")
    rows = met.mapInPandas(measured, "quality int, measures array<double>").toPandas()
    if rows.empty:
        return Model(np.zeros((0, 1)), np.zeros(0))
    return Model(np.stack(rows["measures"].to_list()), rows["quality"].to_numpy(np.float64))


def _evidence(model: Model, text: Column) -> Column:
    """Log-odds of a text being good; null for none."""

    @F.pandas_udf("double")
    def log_odds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            some = [t if isinstance(t, str) else "" for t in texts]
            rows = np.array([measures(t) for t in some]).reshape(len(some), -1)
            yield pd.Series(model.log_odds(rows)).where([bool(t) for t in some])

    return log_odds(text)


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _log_odds(rate: Column) -> Column:
    safe = F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


def _strength(mean: Column, variance: Column, settings: Settings) -> Column:
    """Documents a beta prior counts for, from the mean and variance of rates (by moments)."""
    found = mean * (1 - mean) / F.greatest(variance, F.lit(1e-9)) - 1
    return F.least(F.greatest(found, F.lit(1.0)), F.lit(settings.strongest))


def posteriors(scored: DataFrame, settings: Settings) -> DataFrame:
    """host, path, n, good (sums of the path), strength and host_rate of each path, and the global rate.

    ``scored`` has host, path and p (null where a document holds no evidence).
    """
    spark = scored.sparkSession
    folder = scratch_path(spark, "quality")
    paths = scored.groupBy("host", "path").agg(
        F.count("p").cast("double").alias("n"), F.coalesce(F.sum("p"), F.lit(0.0)).alias("good")
    )
    paths.write.parquet(f"{folder}/paths")
    paths = spark.read.parquet(f"{folder}/paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    rate = F.col("host_good") / F.greatest("host_n", F.lit(1.0))
    # a weighted variance of host rates, less what chance alone would give
    whole = hosts.agg(
        F.sum("host_n").alias("n"),
        F.sum("host_good").alias("good"),
        F.sum(F.col("host_n") * rate * rate).alias("squares"),
        F.sum(F.when(F.col("host_n") > 0, rate * (1 - rate)).otherwise(0.0)).alias("chance"),
    ).first()
    n = whole["n"] or 0.0
    overall = whole["good"] / n if n else 0.5
    spread = (whole["squares"] - whole["chance"]) / n - overall**2 if n else 0.0
    strength = _strength(F.lit(overall), F.lit(spread), settings)
    host_rate = (F.col("host_good") + F.lit(overall) * strength) / (F.col("host_n") + strength)
    hosts = hosts.select(F.col("host").alias("of"), host_rate.alias("host_rate"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("good") / F.greatest("n", F.lit(1.0))
    within = both.agg(
        F.sum(F.col("n") * (own - F.col("host_rate")) ** 2).alias("squares"),
        F.sum(F.when(F.col("n") > 0, own * (1 - own)).otherwise(0.0)).alias("chance"),
    ).first()
    inner = (within["squares"] - within["chance"]) / n if n else 0.0
    return both.withColumns(
        {"strength": _strength(F.lit(overall), F.lit(inner), settings), "overall": F.lit(overall)}
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    settings: Settings = Settings(),
) -> DataFrame:
    """``doc`` (a struct of all columns) with evidence, host_rate, path_rate, probability and kept."""
    model = fit(docs, labels, settings)
    scored = docs.select(
        F.struct("*").alias("doc"),
        F.col(host).alias("host"),
        F.col(path).alias("path"),
        _evidence(model, F.col("text")).alias("evidence"),
    ).withColumn("p", _probability(F.col("evidence")))
    found = posteriors(scored.select("host", "path", "p"), settings)
    folder = scratch_path(docs.sparkSession, "posteriors")
    found.write.parquet(folder)
    found = docs.sparkSession.read.parquet(folder).withColumnsRenamed({"host": "of_host", "path": "of_path"})
    if found.count() <= _BROADCAST_PATHS:
        found = F.broadcast(found)
    met = scored.join(
        found, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    )
    # the document's own share is taken out of its path
    one = F.col("p").isNotNull().cast("double")
    rest = F.col("good") - F.coalesce("p", F.lit(0.0)) + F.col("host_rate") * F.col("strength")
    path_rate = rest / (F.col("n") - one + F.col("strength"))
    odds = F.coalesce("evidence", _log_odds(F.col("overall"))) + settings.weight * (
        _log_odds(F.col("path_rate")) - _log_odds(F.col("overall"))
    )
    kept = F.col("evidence").isNull() | (F.col("probability") >= settings.least) | F.lit(not model.known)
    return (
        met.withColumn("path_rate", path_rate)
        .withColumn("probability", _probability(odds))
        .select("doc", "evidence", "host_rate", "path_rate", "probability", kept.alias("kept"))
    )
