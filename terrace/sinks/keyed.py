"""A catalog table that is updated by key, one batch at a time.

The table is partitioned by a key column (if one is given) and by a hash bucket of key columns.  A
merge writes the latest rows of its batch by partition.  Partitions that the table lacks are pointed to these
files in the catalog; of the others that the batch touches it reads what they hold, writes
their new rows to a folder of their own and points them there.  No file is overwritten: a reader that has begun
finishes on what it found, and a merge that stops before its last step leaves the old rows.
One that stops among partitions has replaced some of them, which merging the batch again completes: the
latest row of a key wins, however often it comes.  There may be one writer at a time.

``name`` is a view without the bucket column; the partitions belong to ``name__rows``.  The partitions of each
batch stay noted in a folder below ``path__changes`` until ``forget_changes``, for those who
bring other tables up to date.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.files import folders, remove
from terrace.operators.upsert import latest_by_key, upsert
from terrace.sinks.clustered import cluster
from terrace.sinks.tables import (
    declare_table,
    grow_table,
    known_partitions,
    point_partitions,
    set_properties,
    stage_partitions,
    swap_partitions,
)

BUCKET = "key_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """Where the table lives and how its rows are identified and ordered.

    ``buckets`` is the number of partitions for each value of ``partition_by``; it is fixed with the first
    merge, so choose it for the size that the table will have (a merge of one row rewrites
    one partition).  ``bucket_by`` names the keys that are hashed, all by default.
    """

    name: str
    path: str
    keys: tuple[str, ...]
    sequence: str
    ties: tuple[str, ...] = ()
    partition_by: str | None = None
    buckets: int = 16
    bucket_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.partition_by is not None and self.partition_by not in self.keys:
            raise ValueError("partition_by must be a key, or a key could live in two partitions")
        if not set(self.bucket_by) <= set(self.keys):
            raise ValueError("bucket_by must be keys, or a key could live in two partitions")

    @property
    def rows_name(self) -> str:
        return f"{self.name}__rows"

    @property
    def levels(self) -> list[str]:
        """The partition columns."""
        return [BUCKET] if self.partition_by is None else [self.partition_by, BUCKET]

    def bucket(self) -> Column:
        hashed = F.xxhash64(*(self.bucket_by or self.keys))
        return F.pmod(hashed, F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession) -> DataFrame:
        """The current content."""
        return self.read_rows(spark).drop(BUCKET)

    def read_rows(self, spark: SparkSession) -> DataFrame:
        """The current content with the bucket of each row; filters on it and on the partition prune."""
        if not spark.catalog.tableExists(self.rows_name):
            raise ValueError(f"nothing was merged into {self.name} yet")
        return spark.table(self.rows_name)

    def merge(self, changes: DataFrame) -> list[tuple]:
        """Apply one batch of changes; returns the partitions that it touched (see ``levels``)."""
        spark = changes.sparkSession
        # Written and not cached: the batch is computed once and survives lost executors.
        bucketed = changes.withColumn(BUCKET, self.bucket())
        latest = latest_by_key(bucketed, self.keys, self.sequence, self.ties)
        staged = stage_partitions(latest, self.path, self.levels)
        written = folders(spark, staged, len(self.levels))
        if not written:
            remove(spark, staged)
            return []
        batch = spark.read.schema(latest.schema)
        rows = batch.parquet(staged).select(*latest.columns)
        touched = self._partitions(rows)
        noted = spark.createDataFrame(touched, rows.select(*self.levels).schema)
        noted.coalesce(1).write.parquet(f"{self._changes}/batch={uuid.uuid4().hex}")
        self._declare(spark, rows.schema)
        known = known_partitions(spark, self.rows_name)
        held = [f"{staged}/{p}" for p in written if p in known]
        if held:
            incoming = batch.option("basePath", staged).parquet(*held)
            current = spark.table(self.rows_name).where(self._within(self._partitions(incoming)))
            merged = upsert(current, incoming, self.keys, self.sequence, self.ties)
            swap_partitions(merged, self.rows_name, self.path, self.levels)
        point_partitions(spark, self.rows_name, staged, self.levels, only_new=True)
        return touched

    def changed_partitions(self, spark: SparkSession) -> tuple[list[str], list[tuple]]:
        """The batches since ``forget_changes`` and the partitions that they have touched."""
        batches = folders(spark, self._changes)
        if not batches:
            return [], []
        return batches, self._partitions(spark.read.parquet(*(f"{self._changes}/{b}" for b in batches)))

    def _partitions(self, rows: DataFrame) -> list[tuple]:
        """Partitions that occur in ``rows``: as many as the table has at most."""
        return [tuple(r) for r in rows.select(*self.levels).distinct().collect()]

    def forget_changes(self, spark: SparkSession, batches: Sequence[str]) -> None:
        for batch in batches:
            remove(spark, f"{self._changes}/{batch}")

    def optimize(
        self, spark: SparkSession, columns: Sequence[str], rows_per_file: int = 5_000_000
    ) -> None:
        """Rewrite all partitions, compacted and clustered on ``columns``."""
        current = self.read_rows(spark)
        rows = current.count()
        files = max(1, ceil(rows / rows_per_file))
        path = f"{self.path}/{uuid.uuid4().hex}"
        cluster(current, columns, files, rows, self.levels).write.partitionBy(*self.levels).parquet(path)
        point_partitions(spark, self.rows_name, path, self.levels)

    def describe(
        self, spark: SparkSession, comment: str | None = None, properties: Mapping[str, str] | None = None
    ) -> None:
        set_properties(spark, self.rows_name, comment, properties)

    @property
    def _changes(self) -> str:
        return f"{self.path}__changes"

    def _declare(self, spark: SparkSession, schema: T.StructType) -> None:
        """Create the table, or add the columns that came with a batch."""
        known = spark.catalog.tableExists(self.rows_name)
        declare_table(spark, self.rows_name, schema, path=self.path, partition_by=self.levels)
        if not known or grow_table(spark, self.rows_name, schema):
            columns = spark.table(self.rows_name).columns
            shown = ", ".join(f"`{c}`" for c in columns if c != BUCKET)
            spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT {shown} FROM {self.rows_name}")

    def _within(self, partitions: Sequence[tuple]) -> Column:
        """Whether a row belongs to one of ``partitions``; literals, so that the scan is pruned."""
        buckets: dict[tuple, list[int]] = {}
        for *value, bucket in partitions:
            buckets.setdefault(tuple(value), []).append(bucket)
        found = F.lit(False)
        for value, numbers in buckets.items():
            one = F.col(BUCKET).isin(numbers)
            for v in value:
                column = F.col(self.partition_by)
                one &= column.isNull() if v is None else column == F.lit(v)
            found |= one
        return found
