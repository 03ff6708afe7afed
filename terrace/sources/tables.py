"""Table scans, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.table(name)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet table as a stream: each file is read once per checkpoint.

    ``path`` may be a folder, or a glob that matches folders or files.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_named(spark: SparkSession, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A catalog table as a stream of the rows that are appended to it."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.table(name)


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Columns, types and storage details of a catalog table."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
