"""Compact and cluster a table on several columns (z-order), as a rewrite job.

Each column is replaced by its quantile bucket, the bucket bits are interleaved,
and rows are range-partitioned and sorted by the result, so every file covers a
small box in all columns and Parquet min/max statistics can skip it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.search import with_bounds_below

_SALT = "_salt"
_ZONE = "_zone"


def bucket_bounds(
    df: DataFrame, columns: Sequence[str], bits: int, rows: int, sample_rows: int = 2_000_000
) -> dict[str, list]:
    """Up to ``2**bits - 1`` distinct quantiles per column.

    Taken from a sample of fixed size: bounds decide in which file a row is stored and
    never whether it is.
    """
    drawn = df.select(*columns)
    if rows > sample_rows:
        drawn = drawn.sample(sample_rows / rows, seed=17)
    steps = 2**bits
    quantiles = [i / steps for i in range(1, steps)]
    found = drawn.agg(
        *[F.array_distinct(F.percentile_approx(c, quantiles, 20 * steps)).alias(c) for c in columns]
    ).first()
    return {c: found[c] or [] for c in columns}


def interleave(buckets: Sequence[Column], bits: int) -> Column:
    """One number whose bits come from the buckets in turn, highest bits first."""
    width = len(buckets)
    placed = [
        F.shiftleft(
            F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * width + offset
        )
        for bit in range(bits)
        for offset, bucket in enumerate(reversed(buckets))
    ]
    return reduce(Column.bitwiseOR, placed)


def cluster(
    df: DataFrame,
    columns: Sequence[str],
    files: int,
    rows: int,
    partition_by: Sequence[str] = (),
    salt: Column | None = None,
) -> DataFrame:
    """``df`` in ``files`` range partitions, each sorted along the z-order of ``columns``.

    The range key ends with the columns themselves and a salt, so neither a frequent
    value nor a frequent combination has to fit into one task.
    """
    # a few zones per file in every column; 12 bits of two columns part 16 million files, and within a
    # zone the columns themselves go on ordering
    bits = max(4, min(12, ceil(log2(max(files, 2)) / len(columns)) + 2))
    bounds = bucket_bounds(df, columns, bits, rows)
    plain = df.columns
    if salt is None:
        salt = F.xxhash64(*plain)
    buckets = {
        f"_bucket_{i}": (c, F.array(*map(F.lit, bounds[c]))) for i, c in enumerate(columns)
    }
    placed = with_bounds_below(df.withColumn(_SALT, salt), buckets, 2**bits - 1).withColumn(
        _ZONE, interleave([F.col(b) for b in buckets], bits)
    )
    zone = [*partition_by, _ZONE]
    return (
        placed.repartitionByRange(files, *zone, *columns, _SALT)
        .sortWithinPartitions(*zone)
        .select(*plain)
    )


def rewrite_clustered(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    rows_per_file: int = 5_000_000,
    partition_by: Sequence[str] = (),
) -> None:
    """Write the Parquet files at ``source`` to ``target``, compacted and clustered.

    The salt is the place of a row in its file: it splits even groups of identical
    rows, and a retried task computes the same value again.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the rewrite needs a target of its own")
    table = spark.read.parquet(source)
    rows = table.count()
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    files = max(1, ceil(rows / rows_per_file))
    writer = cluster(table, columns, files, rows, partition_by, place).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("maxRecordsPerFile", 2 * rows_per_file).parquet(target)


def optimize_table(
    spark: SparkSession, name: str, columns: Sequence[str], rows_per_file: int = 5_000_000
) -> str:
    """Cluster an unpartitioned Parquet table and point the table at the new files.

    The old files stay as they are, so running queries are not disturbed.  Returns
    the new location.
    """
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(
        "col_name IN ('Location', '# Partition Information')"
    )
    found = {row["col_name"]: row["data_type"] for row in details.collect()}
    if "# Partition Information" in found:
        raise ValueError(f"{name} is partitioned; use rewrite_clustered with partition_by")
    location = found["Location"]
    base = location.rstrip("/").split("__clustered_")[0]
    target = f"{base}__clustered_{uuid.uuid4().hex}"
    rewrite_clustered(spark, location, target, columns, rows_per_file)
    place = target.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    return target
