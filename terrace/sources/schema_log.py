"""Schemas that outlive a run, kept as a small append-only JSON dataset."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.files import exists

_LINE = "version int, schema string"


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The newest schema at ``path``, or ``None`` if none was saved."""
    version, schema = _newest(spark, path)
    return schema


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Append ``schema`` as a new version unless it is the newest already."""
    version, newest = _newest(spark, path)
    if newest == schema:
        return
    line = [F.lit(version + 1).alias("version"), F.lit(schema.json()).alias("schema")]
    spark.range(1).coalesce(1).select(*line).write.mode("append").json(path)


def union_types(known: T.StructType | None, added: T.StructType) -> T.StructType:
    """``known`` followed by the fields of ``added`` that it lacks."""
    fields = {f.name.lower(): f for f in known or ()}
    for f in added:
        fields.setdefault(f.name.lower(), T.StructField(f.name, f.dataType))
    return T.StructType(list(fields.values()))


def _newest(spark: SparkSession, path: str) -> tuple[int, T.StructType | None]:
    if not exists(spark, path):
        return 0, None
    lines = spark.read.schema(_LINE).json(path)
    newest = lines.orderBy(F.col("version").desc()).first()
    if newest is None:
        return 0, None
    return newest["version"], T.StructType.fromJson(json.loads(newest["schema"]))
