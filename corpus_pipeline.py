"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept:

1. ``quality``: rejected documents go;
2. ``near_duplicates``: one document of each group stays;
3. ``decontamination``: documents that hold a benchmark item go;
4. ``mixing``: documents are repeated or left out by their source's rate, in global random order;
5. ``token_output``: ids are written in Huffman blocks and read back, one row per document copy.

All but the last return the columns of ``documents``.  Rows with nulls and empty tables go through
each stage as its operator states.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import decontaminate, minhash, mixing, site_quality, token_output
from terrace.plans.registry import table
from terrace.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

END_ID = 1


def _same_columns(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select(*(F.col("doc")[c].alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    found = site_quality.classify(docs, table(spark, sf_dir, "labels"))
    return _same_columns(found.where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five words, 0.8): the one with the smallest doc_id.

    Null comes after all doc_ids.  Among rows of one doc_id that has several texts in a group, the least
    md5 stays, and among rows that repeat doc_id and text, the one whose other columns are least.
    """
    settings = minhash.Settings(words=5, percent=80, bands=30)
    found = minhash.near_duplicates(docs, settings)
    # without a doc_id, text is all that names a row
    stays = F.col("doc_id").eqNullSafe(F.col("stays_id")) & (F.col("text_md5") == F.col("stays_md5"))
    gone = found.where(~stays).select("doc_id", "text_md5").distinct()
    name = F.md5(F.coalesce("text", F.lit("")))
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), name.alias("name"))
    left = packed.join(
        gone,
        packed["id"].eqNullSafe(gone["doc_id"]) & (packed["name"] == gone["text_md5"]),
        "left_anti",
    )
    others = F.to_json(F.struct(F.lit(0), *(F.col("doc")[c] for c in docs.columns if c != "text")))
    return _same_columns(left.groupBy("id", "name").agg(F.min_by("doc", others).alias("doc")), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by the rates of their sources."""
    return mixing.mix(docs).select(*docs.columns)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the written files hold: doc_id, start, n_tokens and ids_crc32 of every row."""
    path = scratch_path(spark, "tokens")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    token_output.write_tokens(docs, path, vocabulary, END_ID)
    return token_output.token_digest(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_output", write_ids),
]

#: Classifier, hashes and code tables are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
