"""How the sources of a language differ in their words.

1. A text's terms (runs of letters and non-ASCII signs, A-Z lower-cased) are named by language, so
   one ``CountVectorizer`` with minDF and the greatest integer as vocabSize counts each language by itself.
   Its vocabulary lives on the driver: when more terms than ``terms_per_fit`` are kept (counted before,
   by hash), terms are dealt by hash to as many fits as keep each below it.  Texts are split
   into terms once and written; with several fits, once more with one part per fit.
2. The sparse vectors of documents are summed per (lang, source) and per lang, before and after
   the shuffle.  Only counts above 0 are rows.
3. With p = 1 + floor(scale * (count + 2) / (N + 2 V)), two sources differ in a term by
   f = floor((p - q)^2 / (p + q)).  Terms that one source lacks have the same q there, so the sum over
   all kept terms is a sum over the histogram of each source's counts, corrected for the
   terms that both have: only these meet in a join.

All arithmetic is in whole numbers; p is computed in decimals, as counts times ``scale`` pass 64 bits.
f is symmetric, so each two sources meet once.  A pair of sources is a row of the result by contract;
the pairs of one language are dealt to ``_DEALT`` parts.

Null text, lang and source are empty.  Empty texts have no terms; their (lang, source) still is a
group.  Repeated rows are different documents.  A table without rows has no result.  Texts are
counted whole.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.session import scratch_path

#: What stands between terms.
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Between language and term; no term holds it.
_MARK = "\x01"
_DEALT = 64


@dataclass(frozen=True)
class Settings:
    min_docs: int = 10
    scale: int = 1_000_000_000
    top: int = 10
    terms_per_fit: int = 2_000_000


def named_terms(docs: DataFrame) -> DataFrame:
    """lang, source and terms: every term of a text, in order, behind its language."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text, lang = F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    small = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, lower))
    found = F.filter(F.split(small, _BETWEEN), lambda t: t != "")
    return docs.select(
        lang.alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.transform(found, lambda t: F.concat(lang, F.lit(_MARK), t)).alias("terms"),
    )


def _dealt(named: DataFrame, parts: int) -> DataFrame:
    """part, lang, source and the terms of a text that fall to that part by hash."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, source, terms in zip(batch["lang"], batch["source"], batch["terms"], strict=True):
                pieces: dict[int, list[str]] = {}
                for term in terms:
                    pieces.setdefault(crc32(term.encode()) % parts, []).append(term)
                out += [(part, lang, source, some) for part, some in pieces.items()]
            yield pd.DataFrame(out, columns=["part", "lang", "source", "terms"])

    return named.mapInPandas(deal, "part int, lang string, source string, terms array<string>")


def _fits(named: DataFrame, settings: Settings, path: str) -> list[DataFrame]:
    """lang, source and terms, once for each fit; each keeps about ``terms_per_fit`` terms at most."""
    spark = named.sparkSession
    named.write.parquet(f"{path}/texts")
    stored = spark.read.parquet(f"{path}/texts")
    # hashes for terms: only how many are kept matters here
    seen = stored.select(F.explode(F.array_distinct("terms")).alias("term")).select(F.xxhash64("term").alias("term"))
    often = seen.groupBy("term").agg(F.count("*").alias("docs")).where(F.col("docs") >= settings.min_docs)
    parts = ceil(1.1 * often.count() / settings.terms_per_fit)
    if parts <= 1:
        return [stored]
    # written where the texts are: their terms are not shuffled
    _dealt(stored, parts).write.partitionBy("part").parquet(f"{path}/parts")
    dealt = spark.read.parquet(f"{path}/parts")
    return [dealt.where(F.col("part") == n).select("lang", "source", "terms") for n in range(parts)]


def _model(named: DataFrame, settings: Settings) -> CountVectorizerModel:
    # a term that no text can hold: a fit without any kept term is an error
    empty = named.sparkSession.range(settings.min_docs).select(F.array(F.lit(_MARK)).alias("terms"))
    vectorizer = CountVectorizer(
        inputCol="terms", outputCol="vector", minDF=float(settings.min_docs), vocabSize=2**31 - 1
    )
    return vectorizer.fit(named.select("terms").union(empty))


def source_counts(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """lang, source, word and count of every kept term that a source has, and word and term of the
    vocabulary of every language; both in the shared folder."""
    spark = docs.sparkSession
    path = scratch_path(spark, "divergence")
    for number, named in enumerate(_fits(named_terms(docs), settings, path)):
        model = _model(named, settings)
        _vocabulary(spark, model, number).write.mode("append").parquet(f"{path}/words")
        vectors = model.transform(named).select("lang", "source", F.unwrap_udt("vector").alias("v"))
        cells = vectors.select(
            "lang", "source", F.explode(F.arrays_zip("v.indices", "v.values")).alias("cell")
        )
        word = (F.col("cell.indices").cast("long") + F.lit(number << 32)).alias("word")
        counts = cells.groupBy("lang", "source", word).agg(
            F.sum(F.col("cell.values").cast("long")).alias("count")
        )
        counts.write.mode("append").parquet(f"{path}/counts")
    return spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/words")


def _vocabulary(spark: SparkSession, model: CountVectorizerModel, number: int) -> DataFrame:
    """word and term of a fit's vocabulary."""
    named = pa.table({"term": pa.array(model.vocabulary, pa.string())})
    numbered = named.append_column("word", pa.array(range(number << 32, (number << 32) + len(named)), pa.int64()))
    # the vocabulary's names begin with the language
    return spark.createDataFrame(numbered).select("word", F.substring_index("term", _MARK, -1).alias("term"))


def _share(count: Column, total: Column, kept: Column, scale: int) -> Column:
    """p of a term, exactly."""
    upper = F.lit(scale).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    lower = total.cast("decimal(20,0)") + 2 * kept.cast("decimal(19,0)")
    return 1 + F.call_function("div", upper, lower)


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("group").orderBy(F.desc("value"), F.asc("item"))
    return found.select(
        "group", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def source_divergence(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair``: every other source of the language with the sum of f over all kept terms.  Part
    ``term``: the ``top`` terms that a source has more of than its language, by f.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "divergence")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    counts, words = source_counts(docs, settings)
    groups = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")
    ).distinct()
    by_word = written(counts.groupBy("lang", "word").agg(F.sum("count").alias("lang_count")), "by-word")
    by_lang = by_word.groupBy("lang").agg(
        F.count("*").alias("kept"), F.sum("lang_count").alias("lang_total")
    )
    by_source = counts.groupBy("lang", "source").agg(
        F.count("*").alias("own"), F.sum("count").alias("total")
    )
    zero = F.lit(0).cast("long")
    sizes = (
        groups.join(by_source, ["lang", "source"], "left")
        .join(by_lang, "lang", "left")
        .na.fill(0, ["own", "total", "kept", "lang_total"])
        .withColumn(
            "none",  # p of a term that the source lacks
            F.when(F.col("kept") > 0, _share(zero, F.col("total"), F.col("kept"), settings.scale)),
        )
        .withColumn("group", F.monotonically_increasing_id())
    )
    sizes = written(sizes, "sizes")
    p = _share(F.col("count"), F.col("total"), F.col("kept"), settings.scale)
    shares = written(
        counts.join(sizes, ["lang", "source"]).select("group", "word", p.alias("p"), "none"), "shares"
    )
    pairs = written(_pairs(sizes, shares), "pairs")

    lang_shares = by_word.join(by_lang, "lang").select(
        "word", _share(F.col("lang_count"), F.col("lang_total"), F.col("kept"), settings.scale).alias("q")
    )
    more = shares.join(lang_shares, "word").where("p > q").join(words, "word")
    terms = more.select("group", F.col("term").alias("item"), _difference(F.col("p"), F.col("q")).alias("value"))
    best = _ranked(terms, "term").where(F.col("rank") <= settings.top)
    names = sizes.select("group", "lang", "source")
    found = _ranked(pairs, "pair").unionByName(best).join(names, "group")
    return found.select("lang", "source", "part", "item", "value", "rank")


def _pairs(sizes: DataFrame, shares: DataFrame) -> DataFrame:
    """group, item (another source of its language) and value, in both directions."""
    other = sizes.select("lang", *(F.col(c).alias(f"{c}_b") for c in ("group", "source", "own", "none")))
    left = sizes.withColumn("deal", F.pmod("group", F.lit(_DEALT)))
    right = other.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_DEALT - 1).cast("long"))))
    both = left.join(right, ["lang", "deal"]).where("group <> group_b").select(
        "group", "group_b", "source", "source_b", "own", "own_b", "kept", "none", "none_b"
    )

    # f of each count that a source has against a source that lacks the term
    steps = shares.groupBy("group", "p").agg(F.count("*").alias("terms"))
    alone = both.join(steps, "group").groupBy("group", "group_b").agg(
        F.sum(F.col("terms") * _difference(F.col("p"), F.col("none_b"))).alias("alone")
    )
    reverse = alone.select(
        F.col("group").alias("group_b"), F.col("group_b").alias("group"), F.col("alone").alias("alone_b")
    )

    # what the sums over single sources count wrongly: terms that both have
    theirs = shares.select(
        "word", F.col("group").alias("group_b"), F.col("p").alias("q"), F.col("none").alias("none_b")
    )
    p, q, none, none_b = (F.col(c) for c in ("p", "q", "none", "none_b"))
    wrong = _difference(p, q) - _difference(p, none_b) - _difference(none, q) + _difference(none, none_b)
    shared = (
        shares.join(theirs, "word")
        .where("group < group_b")
        .groupBy("group", "group_b")
        .agg(F.sum(wrong).alias("shared"))
    )
    key = ["group", "group_b"]
    once = both.where("group < group_b")
    summed = once.join(alone, key, "left").join(reverse, key, "left").join(shared, key, "left")
    neither = (F.col("kept") - F.col("own") - F.col("own_b")) * _difference(none, none_b)
    value = F.coalesce("alone", F.lit(0)) + F.coalesce("alone_b", F.lit(0)) + F.coalesce("shared", F.lit(0))
    value = F.coalesce(value + neither, F.lit(0)).cast("long").alias("value")
    return summed.select("group", F.col("source_b").alias("item"), value).unionByName(
        summed.select(F.col("group_b").alias("group"), F.col("source").alias("item"), value)
    )
