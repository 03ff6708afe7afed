"""Paths on any Hadoop file system: existence, folder names, first lines, removal.

These few calls need the classic session; the Connect client has no file system API.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _resolve(spark, path)
    return system.exists(hadoop)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    hadoop, system = _resolve(spark, path)
    system.delete(hadoop, True)


def folders(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Paths of the folders ``depth`` levels below ``path``, relative to it; hidden ones are skipped."""
    found = [""]
    for _ in range(depth):
        deeper = []
        for part in found:
            hadoop, system = _resolve(spark, f"{path}/{part}" if part else path)
            if not system.exists(hadoop):
                continue
            for status in system.listStatus(hadoop):
                name = status.getPath().getName()
                if status.isDirectory() and name[0] not in "_.":
                    deeper.append(f"{part}/{name}" if part else name)
        found = deeper
    return sorted(found)


#: What Java's trim removes; Spark takes lines of these alone as blank.
_BLANKS = "".join(map(chr, range(0x21)))


def first_lines(
    spark: SparkSession,
    paths: Sequence[str],
    charset: str = "UTF-8",
    comment: str | None = None,
    limit: int = 1 << 22,
) -> list[str | None]:
    """The first line of each file that is neither blank nor begins with ``comment``; ``None`` without one.

    Read by threads, without a Spark job.  Files that a Hadoop codec compressed are opened through it.
    No more than ``limit`` bytes of a file are read; a header that does not end there is an error.
    """
    jvm = spark.sparkContext._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()
    )

    def first(path: str) -> str | None:
        hadoop, system = _resolve(spark, path)
        stream = system.open(hadoop)
        codec = codecs.getCodec(hadoop)
        if codec is not None:
            stream = codec.createInputStream(stream)
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(stream, limit)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(bounded, charset))
        try:
            while (line := reader.readLine()) is not None:
                if line.strip(_BLANKS) and not (comment and line.startswith(comment)):
                    break
            if bounded.getCount() >= limit and (line is None or reader.readLine() is None):
                raise ValueError(f"{path}: no header within its first {limit} bytes")
            return line
        finally:
            reader.close()

    with ThreadPoolExecutor(max_workers=32) as pool:
        return list(pool.map(first, paths))
