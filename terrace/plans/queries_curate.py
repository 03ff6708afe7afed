"""Latest-wins upserts, change history, summaries, counts and top-N."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.clean import add_tiers
from terrace.operators.explore import (
    counts_by,
    load_report,
    preview,
    row_count,
    top_rows,
    top_values,
)
from terrace.operators.history import change_history
from terrace.operators.summary import summarize
from terrace.operators.upsert import latest_by_key, upsert
from terrace.plans.queries_clean import PRICE_TIER
from terrace.plans.registry import query, table
from terrace.profile import Measure

SPLIT = datetime(1995, 6, 17)

_LATEST_ORDERS = """
    SELECT * EXCLUDE (nth) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
        FROM orders)
    WHERE nth = 1
"""


@query(_LATEST_ORDERS)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return latest_by_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(_LATEST_ORDERS)
def upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    keys, sequence, ties = ["o_custkey"], "o_orderdate", ["o_orderkey"]
    newer = orders.where(F.col("o_orderdate") >= F.lit(SPLIT))
    older = orders.where(F.col("o_orderdate") < F.lit(SPLIT))
    return upsert(latest_by_key(newer, keys, sequence, ties), older, keys, sequence, ties)


@query(
    """
    WITH seen AS (
        SELECT user_id, ts, event_type,
               lag(event_type) OVER w AS before, lead(ts) OVER w AS next_ts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    )
    SELECT user_id, ts, event_type, ts AS valid_from, next_ts AS valid_to,
           next_ts IS NULL AS is_current
    FROM seen WHERE before IS NULL OR event_type <> before
    """
)
def history_appearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    return change_history(
        events, ["user_id"], "ts", "event_type", start="valid_from", end="valid_to"
    )


@query(
    """
    WITH seen AS (
        SELECT user_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before
        FROM events
    ), changes AS (
        SELECT user_id, ts, event_type FROM seen WHERE before IS NULL OR event_type <> before
    ), periods AS (
        SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts FROM changes
    )
    SELECT user_id, ts, event_type, ts AS valid_from, next_ts AS valid_to,
           next_ts IS NULL AS is_current
    FROM periods
    """
)
def history_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    return change_history(
        events, ["user_id"], "ts", "event_type", "change", start="valid_from", end="valid_to"
    )


def _history_of_types(closing: str):
    """History of the few, very large ids of ``events``, cut into many pieces."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = table(spark, sf_dir, "events").select(
            "event_type", "ts", "event_id", (F.col("value") >= 50).alias("is_high")
        )
        return change_history(
            events, ["event_type"], "ts", "is_high", closing, ties=["event_id"],
            start="valid_from", end="valid_to", rows_per_piece=500,
        )

    build.__name__ = f"history_{closing}_large_ids"
    return build


query(
    """
    WITH seen AS (
        SELECT event_type, ts, event_id, value >= 50 AS is_high,
               lag(value >= 50) OVER w AS before, lead(ts) OVER w AS next_ts
        FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
    )
    SELECT event_type, ts, event_id, is_high, ts AS valid_from, next_ts AS valid_to,
           next_ts IS NULL AS is_current
    FROM seen WHERE before IS NULL OR is_high <> before
    """
)(_history_of_types("appearance"))

query(
    """
    WITH seen AS (
        SELECT event_type, ts, event_id, value >= 50 AS is_high,
               lag(value >= 50) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before
        FROM events
    ), changes AS (
        SELECT * FROM seen WHERE before IS NULL OR is_high <> before
    ), periods AS (
        SELECT *, lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS next_ts
        FROM changes
    )
    SELECT event_type, ts, event_id, is_high, ts AS valid_from, next_ts AS valid_to,
           next_ts IS NULL AS is_current
    FROM periods
    """
)(_history_of_types("change"))


@query(
    """
    SELECT l_returnflag, l_linestatus, count(*) AS line_count,
           round(avg(l_quantity), 6) AS avg_quantity, max(l_quantity) AS max_quantity
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def summary_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = [
        Measure("line_count", "count"),
        Measure("avg_quantity", "avg", "l_quantity", 6),
        Measure("max_quantity", "max", "l_quantity"),
    ]
    return summarize(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], measures)


@query(
    """
    SELECT l_suppkey, l_returnflag, l_linestatus, count(l_orderkey) AS line_count,
           round(avg(l_quantity), 1) AS avg_quantity,
           round(sum(l_extendedprice), 0) AS total_price,
           round(sum(l_extendedprice * l_discount), 0) AS total_discount,
           max(l_linenumber) AS max_linenumber, min(l_shipdate) AS first_ship,
           max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus
    """
)
def summary_three_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "discounted", F.col("l_extendedprice") * F.col("l_discount")
    )
    measures = [
        Measure("line_count", "count", "l_orderkey"),
        Measure("avg_quantity", "avg", "l_quantity", 1),
        Measure("total_price", "sum", "l_extendedprice", 0),
        Measure("total_discount", "sum", "discounted", 0),
        Measure("max_linenumber", "max", "l_linenumber"),
        Measure("first_ship", "min", "l_shipdate"),
        Measure("last_ship", "max", "l_shipdate"),
    ]
    return summarize(lines, ["l_suppkey", "l_returnflag", "l_linestatus"], measures)


@query(
    """
    SELECT CASE WHEN o_totalprice >= 400000 THEN 'Top' WHEN o_totalprice >= 200000 THEN 'High'
                WHEN o_totalprice >= 50000 THEN 'Middle' ELSE 'Low' END AS price_tier,
           o_orderstatus, count(o_orderkey) AS order_count, round(avg(o_totalprice), 0) AS avg_price,
           max(o_orderdate) AS last_order
    FROM orders GROUP BY ALL
    """
)
def summary_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_totalprice", "price")
    measures = [
        Measure("order_count", "count", "o_orderkey"),
        Measure("avg_price", "avg", "price", 0),
        Measure("last_order", "max", "o_orderdate"),
    ]
    return summarize(add_tiers(orders, [PRICE_TIER]), ["price_tier", "o_orderstatus"], measures)


@query("SELECT * FROM region LIMIT 5")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the feature; the table has five rows, so that the answer is one."""
    return preview(table(spark, sf_dir, "region"), 5)


@query("SELECT count(*) AS row_count FROM events")
def global_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "events"))


@query("SELECT count(*) AS row_count FROM orders WHERE o_orderstatus = 'O'")
def filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "orders"), "o_orderstatus = 'O'")


@query("SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type ORDER BY event_type")
def group_count_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by(table(spark, sf_dir, "events"), "event_type")


@query(
    """
    SELECT o_orderpriority, count(*) AS row_count,
           count(*) FILTER (WHERE o_orderstatus = 'O') AS current_count
    FROM orders GROUP BY o_orderpriority
    """
)
def load_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_report(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus = 'O'")


@query(
    """
    SELECT DISTINCT source, count(*) AS "count" FROM documents WHERE lang = 'en'
    GROUP BY source ORDER BY "count" DESC, source LIMIT 10
    """
)
def distinct_group_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(table(spark, sf_dir, "documents"), "source", 10, "lang = 'en'")


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """
)
def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_rows(
        table(spark, sf_dir, "orders"), 10, "o_totalprice", ["o_orderkey"],
        ["o_orderkey", "o_custkey", "o_totalprice"], "o_orderstatus = 'F'",
    )


@query(
    """
    SELECT user_id, count(*) AS event_count, round(avg(value), 6) AS avg_value, max(value) AS max_value
    FROM events WHERE event_type = 'purchase' GROUP BY user_id
    ORDER BY event_count DESC, user_id LIMIT 10
    """
)
def top_groups_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    measures = [
        Measure("event_count", "count"),
        Measure("avg_value", "avg", "value", 6),
        Measure("max_value", "max", "value"),
    ]
    return top_rows(summarize(purchases, ["user_id"], measures), 10, "event_count", ["user_id"])


@query(
    """
    SELECT l_suppkey, round(sum(l_extendedprice), 0) AS total_price
    FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_suppkey
    ORDER BY total_price DESC, l_suppkey LIMIT 10
    """
)
def top_groups_by_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'N'")
    totals = summarize(lines, ["l_suppkey"], [Measure("total_price", "sum", "l_extendedprice", 0)])
    return top_rows(totals, 10, "total_price", ["l_suppkey"])
