"""Ingest, lineage, table writes, keyed tables, streams and clustering, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.columns import number_in_text
from terrace.operators.explore import preview
from terrace.operators.quality import enforce
from terrace.operators.summary import summarize
from terrace.plans.queries_curate import SPLIT
from terrace.plans.registry import query, table
from terrace.profile import Measure, Rule
from terrace.session import scratch_path
from terrace.sinks.clustered import optimize_table, rewrite_clustered
from terrace.sinks.keyed import KeyedTable
from terrace.sinks.tables import (
    current_layer,
    declare_table,
    ensure_layer,
    export_external,
    grow_table,
    layer_details,
    save_files,
    save_table,
    table_properties,
    use_layer,
)
from terrace.sources.delimited import read_by_header
from terrace.sources.lineage import with_lineage
from terrace.sources.tables import describe, scan, stream_named, stream_table
from terrace.streaming.ingest import RawTable
from terrace.streaming.jobs import (
    append_available_now,
    keep_progress,
    save_rule_counts,
    summary_available_now,
    upsert_from_state,
)

YEAR_IN_PATH = r"order_year=(\d+)"


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A glob works for a table that is one file and for one that is a folder.
    return stream_table(spark, f"{sf_dir}/{name}.parquet*", table(spark, sf_dir, name).schema)


@query(
    """
    SELECT 'lineitem' AS source_table, count(*) AS row_count, max(l_shipdate) AS last_ship
    FROM lineitem
    """
)
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = with_lineage(table(spark, sf_dir, "lineitem").select("l_shipdate"))
    # The path is constant within a file, so its pattern is matched once per file.
    files = lines.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.max("l_shipdate").alias("last")
    )
    source = F.regexp_extract("source_file", r"([a-z]+)\.parquet", 1)
    return files.groupBy(source.alias("source_table")).agg(
        F.sum("rows").alias("row_count"), F.max("last").alias("last_ship")
    )


@query(
    """
    SELECT o_orderkey, TRY_CAST(regexp_extract(o_orderpriority, '(\\d+)-', 1) AS INTEGER) AS rank,
           TRY_CAST(nullif(regexp_extract(o_orderpriority, 'rank (\\d+)', 1), '') AS INTEGER) AS no_rank
    FROM orders
    """
)
def number_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        number_in_text(priority, r"(\d+)-").alias("rank"),
        number_in_text(priority, r"rank (\d+)").alias("no_rank"),
    )


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           CAST(NULL AS VARCHAR) AS o_orderpriority, CAST(NULL AS VARCHAR) AS rescued_status
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), NULL, o_orderpriority, o_orderstatus
    FROM orders WHERE o_orderstatus <> 'F'
    """
)
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "mixed-headers")
    finished = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    others = orders.where("o_orderstatus <> 'F'").select(
        "o_orderpriority", "o_orderkey", "o_orderstatus"
    )
    finished.write.option("header", True).csv(f"{root}/finished")
    others.write.option("header", True).csv(f"{root}/others")
    schema = finished.select(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))
    wanted = schema.withColumn("o_orderpriority", F.lit("")).schema
    return read_by_header(spark, root, schema=wanted).select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        F.get_json_object("_rescued_data", "$.o_orderstatus").alias("rescued_status"),
    )


@query(
    """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
    """
)
def csv_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of CSV files and three runs; the third finds nothing new."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.year("o_orderdate").alias("order_year"),
    )
    root = scratch_path(spark, "ingest")
    raw = RawTable(f"{root}/in", f"{root}/raw", number="order_year", pattern=YEAR_IN_PATH)
    for delivery in ("order_year < 1995", "order_year >= 1995"):
        files = orders.where(delivery).hint("rebalance", "order_year").write.mode("append")
        files.partitionBy("order_year").option("header", True).csv(f"{root}/in")
        raw.ingest(spark)
    raw.ingest(spark)
    return raw.read(spark).select(
        F.col("order_id").try_cast("bigint").alias("o_orderkey"),
        F.col("price").try_cast("double").alias("o_totalprice"),
        "order_year",
    )


_LATEST_PER_PRIORITY = """
    SELECT * EXCLUDE (nth) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
        FROM orders)
    WHERE nth = 1
"""


def _keyed(spark: SparkSession, label: str) -> KeyedTable:
    layer, root = _layer(spark, label)
    return KeyedTable(
        f"{layer}.orders", f"{root}/orders", ("o_custkey", "o_orderpriority"), "o_orderdate",
        ("o_orderkey",), partition_by="o_orderpriority", buckets=2,
    )


@query(_LATEST_PER_PRIORITY)
def upsert_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half first, then the older half, then the newer half again."""
    orders = table(spark, sf_dir, "orders")
    newer = orders.where(F.col("o_orderdate") >= F.lit(SPLIT))
    older = orders.where(F.col("o_orderdate") < F.lit(SPLIT))
    keyed = _keyed(spark, "upsert_batches")
    for batch in (newer, older, newer):
        keyed.merge(batch)
    return keyed.read(spark)


@query(_LATEST_PER_PRIORITY)
def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half first, then the older one, which the state ignores where it is late; then nothing."""
    keyed, feed = _keyed(spark, "upsert_stream"), scratch_path(spark, "upsert-feed")
    orders = table(spark, sf_dir, "orders")
    newer = F.col("o_orderdate") >= F.lit(SPLIT)
    for delivery in (orders.where(newer), orders.where(~newer), orders.where("false")):
        delivery.write.mode("append").parquet(feed)
        stream = stream_table(spark, feed, orders.schema)
        upsert_from_state(stream, f"{keyed.path}__checkpoint", keyed)
    return keyed.read(spark)


@query("SELECT * FROM events")
def stream_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run continues from the checkpoint and adds nothing."""
    root = scratch_path(spark, "append")
    for _ in range(2):
        events = _stream(spark, sf_dir, "events")
        append_available_now(events, f"{root}/checkpoint", path=f"{root}/events")
    return spark.read.parquet(f"{root}/events")


@query(
    """
    SELECT event_type, user_id, count(*) AS event_count, round(avg(value), 6) AS avg_value,
           max(value) AS max_value
    FROM events GROUP BY event_type, user_id
    """
)
def stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = [
        Measure("event_count", "count"),
        Measure("avg_value", "avg", "value", 6),
        Measure("max_value", "max", "value"),
    ]
    layer, root = _layer(spark, "summary")
    events = table(spark, sf_dir, "events")
    for rest in (0, 1):
        events.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(f"{root}/feed")
        stream = stream_table(spark, f"{root}/feed", events.schema)
        summary = summarize(stream, ("event_type", "user_id"), measures)
        summary_available_now(summary, f"{root}/checkpoint", f"{layer}.summary", f"{root}/summary")
    return scan(spark, f"{layer}.summary")


@query("SELECT * FROM orders")
def stream_between_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended to one catalog table stream by name to another, over three runs."""
    layer, root = _layer(spark, "between")
    orders = table(spark, sf_dir, "orders")
    newer = F.col("o_orderdate") >= F.lit(SPLIT)
    for delivery in (orders.where(newer), orders.where(~newer), orders.where("false")):
        save_table(delivery, f"{layer}.incoming", mode="append")
        stream = stream_named(spark, f"{layer}.incoming", files_per_batch=2)
        append_available_now(stream, f"{root}__checkpoint", table=f"{layer}.copied")
    return scan(spark, f"{layer}.copied")


_CHECKED = (
    Rule("fair_quantity", "l_quantity BETWEEN 5 AND 45"),
    Rule("no_returns", "l_returnflag <> 'R'"),
    Rule("cheap", "l_extendedprice < 50000", "warn"),
)


@query(
    """
    WITH lines AS (SELECT *, l_linenumber > 3 AS late FROM lineitem),
    counted AS (
        SELECT late, 'rows' AS rule, count(*) AS violations FROM lines GROUP BY late
        UNION ALL
        SELECT late, 'fair_quantity', count(*) FILTER (NOT l_quantity BETWEEN 5 AND 45) FROM lines GROUP BY late
        UNION ALL
        SELECT late, 'no_returns', count(*) FILTER (l_returnflag = 'R') FROM lines GROUP BY late
        UNION ALL
        SELECT late, 'cheap', count(*) FILTER (l_extendedprice >= 50000) FROM lines GROUP BY late
    )
    SELECT CAST(late AS BIGINT) AS batch_id, rule, violations FROM counted
    """
)
def stream_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules of a running stream counted in each of two deliveries, kept as a table."""
    layer, root = _layer(spark, "counts")
    lines = table(spark, sf_dir, "lineitem")
    keep_progress(spark)
    for delivery in ("l_linenumber <= 3", "l_linenumber > 3"):
        # without a limit of files, all that is there is one micro-batch
        lines.where(delivery).write.mode("append").parquet(f"{root}/feed")
        checked = enforce(stream_table(spark, f"{root}/feed", lines.schema), _CHECKED, "checks")
        query = append_available_now(checked, f"{root}/checkpoint", path=f"{root}/passed")
        save_rule_counts(spark, query, "checks", f"{layer}.rule_counts")
    return scan(spark, f"{layer}.rule_counts").drop("run_id")


@query("SELECT * FROM lineitem")
def clustered_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{scratch_path(spark, 'clustered')}/lineitem"
    columns = ["l_extendedprice", "l_shipdate"]
    rewrite_clustered(spark, f"{sf_dir}/lineitem.parquet", target, columns)
    return spark.read.parquet(target)


def _layer(spark: SparkSession, label: str) -> tuple[str, str]:
    name, root = f"{label}_{uuid.uuid4().hex[:12]}", scratch_path(spark, label)
    ensure_layer(spark, name, root)
    return name, root


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def optimized_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer, _ = _layer(spark, "optimize")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    save_table(orders, f"{layer}.orders", comment="Orders", properties={"quality": "gold"})
    optimize_table(spark, f"{layer}.orders", ["o_totalprice", "o_custkey"])
    return scan(spark, f"{layer}.orders")


@query("SELECT * FROM part")
def external_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported twice: the second copy replaces the first."""
    layer, root = _layer(spark, "export")
    save_table(table(spark, sf_dir, "part"), f"{layer}.part")
    for _ in range(2):
        names = export_external(spark, [(layer, "part", f"{root}_copies/part")])
    return scan(spark, names[0])


@query("SELECT * FROM supplier WHERE s_acctbal >= 0")
def external_export_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy keeps the partitions, and a filter on them reads only these."""
    layer, root = _layer(spark, "export_parts")
    solvent = table(spark, sf_dir, "supplier").withColumn("solvent", F.col("s_acctbal") >= 0)
    save_table(solvent, f"{layer}.supplier", partition_by=["solvent"])
    names = export_external(spark, [(layer, "supplier", f"{root}_copies/supplier")])
    return scan(spark, names[0]).where("solvent").drop("solvent")


@query(
    """
    SELECT c.name AS col_name, c.type AS data_type FROM (VALUES
        ('p_partkey', 'bigint'), ('p_name', 'string'), ('p_brand', 'string'), ('p_type', 'string'),
        ('p_size', 'int'), ('p_retailprice', 'double')) AS c(name, type)
    """
)
def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of a catalog table."""
    layer, _ = _layer(spark, "describe")
    save_table(table(spark, sf_dir, "part"), f"{layer}.part")
    details = describe(spark, f"{layer}.part").select("col_name", "data_type")
    return details.where(F.col("col_name").startswith("p_"))


@query("SELECT * FROM supplier")
def files_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_path(spark, 'files')}/supplier"
    suppliers = table(spark, sf_dir, "supplier")
    save_files(suppliers.where("s_acctbal < 0"), path)
    save_files(suppliers, path)
    return spark.read.parquet(path)


@query(
    """
    SELECT 'Orders of all years' AS comment, 'bronze' AS quality, count(*) AS row_count,
           CAST(sum(o_custkey) AS BIGINT) AS key_sum
    FROM orders
    """
)
def declared_stream_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table declared with comment and property, filled by a stream; all read back by name."""
    layer, root = _layer(spark, "declared")
    name, orders = f"{layer}.orders", table(spark, sf_dir, "orders")
    declare_table(spark, name, orders.schema, "Orders of all years", {"quality": "bronze"})
    append_available_now(_stream(spark, sf_dir, "orders"), f"{root}__checkpoint", table=name)
    return scan(spark, name).agg(
        *_described(spark, name), F.count("*").alias("row_count"), F.sum("o_custkey").alias("key_sum")
    )


@query(
    """
    SELECT 'Orders per status' AS comment, 'gold' AS quality, count(*) AS row_count,
           CAST(sum(n) AS BIGINT) AS order_count
    FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus)
    """
)
def derived_table_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A derived table's comment and property, beside what it holds."""
    layer, _ = _layer(spark, "derived")
    name = f"{layer}.order_counts"
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    save_table(counts, name, comment="Orders per status", properties={"quality": "gold"})
    return scan(spark, name).agg(
        *_described(spark, name), F.count("*").alias("row_count"), F.sum("n").alias("order_count")
    )


def _described(spark: SparkSession, name: str) -> list[Column]:
    """comment and quality of a table as the catalog has them; null without."""
    quality = table_properties(spark, name).where("key = 'quality'").select("value").first()
    comment = describe(spark, name).where("col_name = 'Comment'").select("data_type").first()
    found = {"comment": comment, "quality": quality}
    return [F.lit(row[0] if row else None).cast("string").alias(n) for n, row in found.items()]


@query("SELECT o_orderstatus, 'current' AS layer, count(*) AS row_count FROM orders GROUP BY o_orderstatus")
def current_layer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table found by its bare name in the current namespace; the one of the same name before is not."""
    before = spark.catalog.currentDatabase()
    other, _ = _layer(spark, "other")
    layer, _ = _layer(spark, "current")
    orders = table(spark, sf_dir, "orders")
    save_table(orders.where("false"), f"{other}.orders")
    save_table(orders, f"{layer}.orders")
    try:
        use_layer(spark, other)
        use_layer(spark, layer)
        name = current_layer(spark).first()["layer"]
        found = scan(spark, "orders")
    finally:
        use_layer(spark, before)
    label = F.lit(name.split("_")[0]).alias("layer")
    return found.groupBy("o_orderstatus", label).agg(F.count("*").alias("row_count"))


@query("SELECT count(*) AS row_count, count(*) AS below_the_location FROM lineitem")
def layer_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table, and those of them in files below the location of its namespace."""
    layer, _ = _layer(spark, "located")
    save_table(table(spark, sf_dir, "lineitem"), f"{layer}.lineitem")
    place = layer_details(spark, layer).where("info_name = 'Location'").first()["info_value"]
    below = F.input_file_name().contains(place.removeprefix("file:"))
    return scan(spark, f"{layer}.lineitem").select(below.alias("below")).agg(
        F.count("*").alias("row_count"), F.count_if("below").alias("below_the_location")
    )


@query("SELECT 10::BIGINT AS row_count, 10::BIGINT AS key_count, 10::BIGINT AS found_count FROM orders LIMIT 1")
def preview_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preview of ten rows of a table that has more: how many rows, keys, and rows of the table."""
    orders = table(spark, sf_dir, "orders")
    shown = preview(orders, 10)
    known = orders.select(*(F.col(c).alias(f"known_{c}") for c in orders.columns))
    met = shown.join(
        known, [F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in orders.columns], "left"
    )
    return met.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("o_orderkey").alias("key_count"),
        F.count("known_o_orderkey").alias("found_count"),
    )


@query(
    """
    SELECT 'o_orderkey' AS col_name, 'bigint' AS data_type, count(*) AS filled FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', count(*) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', count(*) FILTER (year(o_orderdate) >= 1995) FROM orders
    """
)
def describe_grown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of a table whose schema grew, with the rows that have a value there."""
    layer, _ = _layer(spark, "grown")
    name = f"{layer}.orders"
    orders = table(spark, sf_dir, "orders")
    late = F.year("o_orderdate") >= 1995
    save_table(orders.where(~late).select("o_orderkey", "o_totalprice"), name)
    added = orders.where(late).select("o_orderkey", "o_totalprice", "o_orderpriority")
    grow_table(spark, name, added.schema)
    save_table(added, name, mode="append")
    rows = scan(spark, name)
    filled = rows.agg(*(F.count(c).alias(c) for c in rows.columns))
    counts = filled.select(
        F.explode(F.create_map(*(x for c in rows.columns for x in (F.lit(c), F.col(c))))).alias("col_name", "filled")
    )
    types = describe(spark, name).where("data_type <> ''").select("col_name", "data_type")
    return types.join(counts, "col_name")
