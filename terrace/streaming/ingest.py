"""Incremental ingest of CSV files into an append-only raw table.

Spark's file source discovers the files and its checkpoint remembers them, but its
CSV reader takes one header for all.  So the stream carries file names only (the
content column is pruned), and each micro-batch reads its files by header.  A batch
is written to a folder named after the batch and its files: a replayed batch finds
its folder complete and adds nothing, and a new checkpoint cannot hide new files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from terrace.files import is_complete
from terrace.sources.delimited import header_groups, read_groups, union_schema
from terrace.sources.schema_log import load_schema, save_schema, union_types

_FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
LOAD = "load"


@dataclass(frozen=True)
class RawTable:
    """An append-only raw table fed from a folder of CSV files.

    ``new_columns="rescue"`` keeps the columns of the first batch and sends later
    ones to the rescue column; ``"add"`` appends them to the table.
    """

    source: str
    path: str
    glob: str = "*.csv"
    number: str | None = None
    pattern: str | None = None
    new_columns: str = "rescue"
    files_per_batch: int = 1000
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.new_columns not in ("rescue", "add"):
            raise ValueError("new_columns must be 'rescue' or 'add'")

    def ingest(self, spark: SparkSession) -> StreamingQuery:
        """Load the files that no earlier run has loaded, then stop."""
        files = (
            spark.readStream.format("binaryFile")
            .schema(_FILE_LISTING)
            .option("pathGlobFilter", self.glob)
            .option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", self.files_per_batch)
            .load(self.source)
            .select("path")
        )
        query = (
            files.writeStream.option("checkpointLocation", f"{self.path}__checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(self._load)
            .start()
        )
        query.awaitTermination()
        return query

    def schema(self, spark: SparkSession) -> T.StructType:
        """Columns of the table, without the load folder."""
        found = load_schema(spark, f"{self.path}__schema")
        if found is None:
            raise ValueError(f"nothing was loaded into {self.path} yet")
        return found

    def stored_schema(self, spark: SparkSession) -> T.StructType:
        """Columns of the table, with the load folder last."""
        return _stored(self.schema(spark))

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table."""
        schema = self.schema(spark)
        return spark.read.schema(_stored(schema)).parquet(self.path).drop(LOAD)

    def stream(self, spark: SparkSession) -> DataFrame:
        """The table as a stream of newly loaded rows."""
        schema = self.schema(spark)
        return spark.readStream.schema(_stored(schema)).parquet(self.path).drop(LOAD)

    def _load(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Names of at most files_per_batch files.
        paths = sorted(row["path"] for row in batch.collect())
        digest = hashlib.sha256("\n".join(paths).encode()).hexdigest()[:16]
        folder = f"{self.path}/{LOAD}={batch_id:08d}-{digest}"
        if is_complete(spark, folder):
            return
        groups = header_groups(spark, paths, self.options)
        if not groups:
            return
        known = load_schema(spark, f"{self.path}__columns")
        columns = known
        if known is None or self.new_columns == "add":
            columns = union_schema(groups, known)
        rows = read_groups(
            spark, groups, columns, self.number, self.pattern, lineage=True, options=self.options
        )
        save_schema(spark, f"{self.path}__columns", columns)
        save_schema(
            spark,
            f"{self.path}__schema",
            union_types(load_schema(spark, f"{self.path}__schema"), rows.schema),
        )
        rows.write.mode("overwrite").parquet(folder)


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
