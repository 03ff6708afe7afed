"""CSV files whose headers differ, read by column name.

One ``csv()`` call over files with different headers maps cells by position and
shifts values without an error.  Here the header of each file is read first.  Files whose
headers have as many cells are one scan, however many headers they have, and each row is named by the header
of its file; the scans are unioned by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.files import first_lines
from terrace.sources.lineage import with_lineage
from terrace.sources.schema_log import union_types

RESCUED = "_rescued_data"
_MALFORMED = "_malformed_line"
_FILE = "_header_of"
#: Paths of local files are written with one slash or three.
_SCHEME = r"^([A-Za-z0-9+.-]+):/+"


def list_files(spark: SparkSession, path: str, glob: str = "*.csv") -> list[str]:
    """All file paths below ``path``; reads names only, no content."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return sorted(found.inputFiles())


def header_groups(
    spark: SparkSession, paths: Sequence[str], options: Mapping[str, str] | None = None
) -> dict[tuple[str, ...], list[str]]:
    """Paths by header.

    The first line of each file that is neither blank nor a comment is read without a Spark job; a
    header must fit into it.  Spark parses one file for each distinct first line.
    """
    settings = _options(options)
    charset = settings.get("encoding", settings.get("charset", "UTF-8"))
    comment = next((v for k, v in settings.items() if k.lower() == "comment"), "\0")
    lines = first_lines(spark, paths, charset, None if comment == "\0" else comment)
    by_line: dict[str, list[str]] = {}
    for path, line in zip(paths, lines, strict=True):
        if line is not None:
            by_line.setdefault(line, []).append(path)

    def header(line: str, path: str) -> tuple[str, ...]:
        columns = spark.read.options(**settings).csv(path).columns
        if not "".join(columns).strip():  # a line of tabs, which Spark leaves out of the rows only
            columns = spark.read.options(**settings).csv(spark.sparkContext.parallelize([line])).columns
        return tuple(columns)

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(max_workers=16) as pool:
        first = (p[0] for p in by_line.values())
        for same, columns in zip(by_line.values(), pool.map(header, by_line, first)):
            if columns:
                groups.setdefault(columns, []).extend(same)
    return groups


def union_schema(headers: Iterable[Sequence[str]], base: T.StructType | None = None) -> T.StructType:
    """All columns of ``base`` and then of each header in turn, as strings."""
    for header in headers:
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        base = union_types(base, text)
    return T.StructType() if base is None else base


def read_groups(
    spark: SparkSession,
    groups: Mapping[tuple[str, ...], Sequence[str]],
    schema: T.StructType | None = None,
    number: str | None = None,
    pattern: str | None = None,
    lineage: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read header groups into one DataFrame with the columns of ``schema``.

    Columns that a file lacks are null.  Columns outside ``schema``, and the text of
    lines whose cell count does not fit their header, go to the rescue column as
    JSON; it is null for ordinary rows.
    """
    wanted = union_schema(groups) if schema is None else schema
    by_width: dict[int, dict[tuple[str, ...], Sequence[str]]] = {}
    for header, paths in groups.items():
        by_width.setdefault(len(header), {})[header] = paths
    if not by_width:
        raise ValueError("no file with a header")
    scans = [
        _read_width(spark, same, width, wanted, number, pattern, lineage, _options(options))
        for width, same in by_width.items()
    ]
    return reduce(DataFrame.unionByName, scans)


def _read_width(
    spark: SparkSession,
    groups: Mapping[tuple[str, ...], Sequence[str]],
    width: int,
    wanted: T.StructType,
    number: str | None,
    pattern: str | None,
    lineage: bool,
    options: Mapping[str, str],
) -> DataFrame:
    """Files whose headers have ``width`` cells in one scan by place.

    With several headers, the place of each column in a row's file is looked up by the file's path: the map
    has one row per file.
    """
    cells = [f"_cell_{n}" for n in range(width)]
    fields = [T.StructField(c, T.StringType()) for c in (*cells, _MALFORMED)]
    scan = (
        spark.read.options(**options)
        .option("columnNameOfCorruptRecord", _MALFORMED)
        .option("columnPruning", False)
        .schema(T.StructType(fields))
        .csv([p for paths in groups.values() for p in paths])
    )
    extra = []
    if lineage:
        scan = with_lineage(scan, number, pattern)
        extra = [c for c in scan.columns if c not in (*cells, _MALFORMED)]
    if len(groups) == 1:
        header = next(iter(groups))
        named = scan.withColumnsRenamed(dict(zip(cells, header, strict=True)))
        return named.select(*_by_name(header, wanted), *extra)
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    placed = scan.withColumn(_FILE, F.regexp_replace(F.url_decode(encoded), _SCHEME, "$1:/"))
    headers = spark.createDataFrame(
        [
            (re.sub(_SCHEME, r"\1:/", unquote(path)), *_places(header, wanted))
            for header, paths in groups.items()
            for path in paths
        ],
        f"{_FILE} string, _places array<int>, _outside map<string,int>",
    )
    unknown = F.raise_error(F.concat(F.lit("no header is known for "), _FILE)).cast("array<int>")
    row = F.array(*cells)
    columns = [
        F.get(row, F.get(F.coalesce("_places", unknown), F.lit(n))).alias(f.name)
        for n, f in enumerate(wanted)
    ]
    outside = F.transform_values("_outside", lambda _, place: F.get(row, place))
    filled = F.map_filter(
        F.map_concat(outside, F.create_map(F.lit(_MALFORMED), F.col(_MALFORMED))),
        lambda _, value: value.isNotNull(),
    )
    rescued = F.when(F.cardinality(filled) > 0, F.to_json(filled)).alias(RESCUED)
    met = placed.join(F.broadcast(headers), _FILE, "left")
    return met.select(*columns, rescued, *extra)


def _places(header: Sequence[str], wanted: T.StructType) -> tuple[list[int | None], dict[str, int]]:
    """Where a file has each wanted column (none: null), and where its other columns are."""
    present = {c.lower(): n for n, c in enumerate(header)}
    known = {f.name.lower() for f in wanted}
    outside = {c: n for n, c in enumerate(header) if c.lower() not in known}
    return [present.get(f.name.lower()) for f in wanted], outside


def read_by_header(
    spark: SparkSession,
    path: str,
    glob: str = "*.csv",
    schema: T.StructType | None = None,
    number: str | None = None,
    pattern: str | None = None,
    lineage: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All CSV files below ``path``, by column name."""
    groups = header_groups(spark, list_files(spark, path, glob), options)
    return read_groups(spark, groups, schema, number, pattern, lineage, options)


def _by_name(header: Sequence[str], wanted: T.StructType) -> list[Column]:
    present = {c.lower(): c for c in header}
    known = {f.name.lower() for f in wanted}
    columns = [
        F.col(f"`{present[f.name.lower()]}`").alias(f.name)
        if f.name.lower() in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in wanted
    ]
    outside = [F.col(f"`{c}`") for c in header if c.lower() not in known]
    rescued = F.to_json(F.struct(*outside, F.col(_MALFORMED)))
    return [*columns, F.nullif(rescued, F.lit("{}")).alias(RESCUED)]


def _options(options: Mapping[str, str] | None) -> dict[str, str]:
    return {"header": "true", **(options or {})}
