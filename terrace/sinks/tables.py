"""Tables with comment and properties, external copies and layer namespaces."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrace.files import folders

#: How folders of partitions name null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def ensure_layer(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the namespace of a layer, at ``location`` if given, unless it exists."""
    place = f" LOCATION '{_quoted(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def use_layer(spark: SparkSession, name: str) -> None:
    """Make ``name`` the current namespace."""
    spark.catalog.setCurrentDatabase(name)


def declare_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Create an empty table for a stream or an upsert to fill, unless it exists.

    Catalog tables list partition columns last.
    """
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    place = f" LOCATION '{_quoted(path)}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet{parts}{place}")
    set_properties(spark, name, comment, properties)


def grow_table(spark: SparkSession, name: str, schema: T.StructType) -> list[str]:
    """Add the columns of ``schema`` that a table lacks; rows of older files have nulls there."""
    known = {c.lower() for c in spark.table(name).columns}
    added = [f for f in schema.fields if f.name.lower() not in known]
    if added:
        columns = T.StructType([T.StructField(f.name, f.dataType) for f in added]).toDDL()
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return [f.name for f in added]


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Write ``df`` as a table; with ``path`` the table is external."""
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    set_properties(df.sparkSession, name, comment, properties)


def set_properties(
    spark: SparkSession,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Attach a comment and properties to a table."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS '{_quoted(comment)}'")
    if properties:
        pairs = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def replace_table(
    df: DataFrame,
    name: str,
    folder: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> str:
    """Write ``df`` to a new folder below ``folder`` and point the table there.

    ``df`` may read from the table itself, and readers keep the files that they
    started with.  Returns the new location.
    """
    spark = df.sparkSession
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(path)}'")
        grow_table(spark, name, df.schema)
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
    set_properties(spark, name, comment, properties)
    return path


def stage_partitions(df: DataFrame, folder: str, columns: Sequence[str], dealt: bool = False) -> str:
    """Write ``df`` by partition to a new folder below ``folder``; returns the folder.

    With ``dealt`` the rows are written as they come: right for a scan of files that hold one partition
    each, which then makes no more files than it reads and needs no shuffle.
    """
    path = f"{folder}/{uuid.uuid4().hex}"
    # few files for each partition, while a large one still gets many tasks
    rows = df if dealt else df.hint("rebalance", *columns)
    rows.write.partitionBy(*columns).parquet(path)
    return path


def swap_partitions(
    df: DataFrame, name: str, folder: str, columns: Sequence[str], dealt: bool = False
) -> list[str]:
    """Write ``df`` to a new folder below ``folder`` and point its partitions of a table there.

    Partitions that do not occur in ``df`` stay.  ``df`` may read from the table itself, and readers
    keep the files that they started with.  Returns the partitions.  See ``stage_partitions`` for ``dealt``.
    """
    path = stage_partitions(df, folder, columns, dealt)
    return point_partitions(df.sparkSession, name, path, columns)


def point_partitions(
    spark: SparkSession, name: str, path: str, columns: Sequence[str], only_new: bool = False
) -> list[str]:
    """Make the partition folders below ``path`` the partitions of a table, one at a time.

    With ``only_new`` those that the table has already stay where they are.  Returns the partitions.
    """
    written = folders(spark, path, len(columns))
    known = known_partitions(spark, name)
    if only_new:
        written = [p for p in written if p not in known]

    def place(partition: str) -> tuple[str, str]:
        spec = ", ".join(_spec(level) for level in partition.split("/"))
        return f"PARTITION ({spec})", f"LOCATION '{_quoted(f'{path}/{partition}')}'"

    new = [p for p in written if p not in known]
    for partition in written:
        if partition in known:
            spec, location = place(partition)
            spark.sql(f"ALTER TABLE {name} {spec} SET {location}")
    if new:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(' '.join(place(p)) for p in new)}")
    spark.catalog.refreshTable(name)
    return written


def known_partitions(spark: SparkSession, name: str) -> set[str]:
    """The partitions of a table, named like their folders."""
    return {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def _spec(level: str) -> str:
    column, _, value = level.partition("=")
    return f"`{column}` = null" if value == NULL_PARTITION else f"`{column}` = '{_quoted(unquote(value))}'"


def register_partitioned(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    column: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """A catalog table over partitioned Parquet files, up to date with the folders.

    Catalog tables list the partition column last.
    """
    declare_table(spark, name, schema, path=path, partition_by=[column])
    grow_table(spark, name, schema)
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    set_properties(spark, name, comment, properties)


def save_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as a Parquet folder."""
    df.write.mode(mode).parquet(path)


def export_external(
    spark: SparkSession, exports: Iterable[tuple[str, str, str]], suffix: str = "_external"
) -> list[str]:
    """For each (schema, table, path) point ``<table>_external`` at a new full copy below path.

    A copy keeps the partitioning of its table.  It is written to a folder of its own before the
    table is pointed there, so the old copy can be read until then, and stays on storage.
    """
    names = []
    for schema, table, path in exports:
        source, name = f"{schema}.{table}", f"{schema}.{table}{suffix}"
        parts = [c.name for c in spark.catalog.listColumns(source) if c.isPartition]
        rows, place = spark.table(source), f"{path}/{uuid.uuid4().hex}"
        if parts:
            rows = rows.hint("rebalance", *parts)
        rows.write.partitionBy(*parts).parquet(place)
        if spark.catalog.tableExists(name):
            # external: the files of the old copy stay
            spark.sql(f"DROP TABLE {name}")
        declare_table(spark, name, rows.schema, path=place, partition_by=parts)
        if parts:
            spark.catalog.recoverPartitions(name)
        names.append(name)
    return names


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    """key and value of a table's properties."""
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


def layer_details(spark: SparkSession, name: str) -> DataFrame:
    """info_name and info_value of a namespace."""
    return spark.sql(f"DESCRIBE DATABASE {name}")


def current_layer(spark: SparkSession) -> DataFrame:
    """The current namespace, as one row."""
    return spark.sql("SELECT current_schema() AS layer")
