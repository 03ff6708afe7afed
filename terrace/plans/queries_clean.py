"""Selection, casts, renames, text, defaults, tiers, gaps, audit columns, quality rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.operators.clean import (
    add_gaps,
    add_tiers,
    apply_casts,
    clean,
    fill_defaults,
    standardize,
)
from terrace.operators.project import add_audit, rename, select_available, select_strict
from terrace.operators.quality import counter_rows, drop_failing, enforce, quality_report
from terrace.operators.summary import summarize
from terrace.plans.registry import query, table
from terrace.profile import Aliased, Gap, Measure, Profile, Rule, Tier

AT = datetime(2024, 1, 1)

PRICE_TIER = Tier(
    "price_tier", "price", ">=", ((400_000, "Top"), (200_000, "High"), (50_000, "Middle")), "Low"
)
SIZE_TIER = Tier("size_tier", "size", "<", ((10, "Small"), (25, "Medium"), (40, "Large")), "Huge")
BALANCE_TIER = Tier(
    "balance_tier", "balance", ">=", ((7_500, "Gold"), (2_500, "Silver"), (0, "Basic")), "Debt"
)

CUSTOMERS = Profile(
    required=("c_custkey", "c_name", "segment", "nation", "balance_text", "limit_text", "c_phone"),
    casts={"c_custkey": "int", "nation": "int", "balance_text": "double", "limit_text": "int"},
    renames={
        "c_custkey": "customer_id",
        "c_name": "customer_name",
        "balance_text": "balance",
        "limit_text": "credit_limit",
    },
    aliases=(Aliased("nation_key", ("nation", "nation_id")),),
    trimmed=("customer_name",),
    uppered=("segment",),
    defaults={"segment": "UNKNOWN", "balance": 0.0},
    tiers=(BALANCE_TIER,),
    gaps=(Gap("headroom", high="credit_limit", low="balance"),),
)

LINE_RULES = (
    Rule("valid_quantity", "l_quantity BETWEEN 5 AND 45"),
    Rule("valid_flag", "l_returnflag IS NOT NULL AND length(l_returnflag) > 0"),
    Rule("open_line", "nullif(l_linestatus, 'F') = 'O'"),
    Rule("discount_covers_tax", "l_discount >= l_tax", "warn"),
    Rule("not_returned", "nullif(l_returnflag, 'A') <> 'R'", "warn"),
)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def select_strict_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_strict(table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_acctbal"])


@query("SELECT c_custkey, c_mktsegment FROM customer")
def select_available_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["c_custkey", "c_phone", "c_mktsegment"]
    return select_available(table(spark, sf_dir, "customer"), columns)


@query(
    """
    SELECT o_orderkey,
           CAST(trunc(o_totalprice) AS INTEGER) AS price_whole,
           o_totalprice AS price_exact,
           TRY_CAST(o_orderpriority AS INTEGER) AS priority_number
    FROM orders
    """
)
def cast_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("string")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        price.alias("price_whole"),
        price.alias("price_exact"),
        F.col("o_orderpriority").alias("priority_number"),
    )
    casts = {"price_whole": "int", "price_exact": "double", "priority_number": "int", "absent": "int"}
    return apply_casts(raw, casts)


@query(
    """
    SELECT c_custkey AS account_id, c_nationkey AS nation_key, c_acctbal AS balance FROM customer
    UNION ALL
    SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier
    """
)
def rename_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return rename(
        customers.unionByName(suppliers, allowMissingColumns=True),
        {"absent": "never"},
        (
            Aliased("account_id", ("c_custkey", "s_suppkey")),
            Aliased("nation_key", ("c_nationkey", "s_nationkey")),
            Aliased("balance", ("c_acctbal", "s_acctbal")),
        ),
    )


@query(
    """
    SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name,
           trim(upper(' ' || lower(c_mktsegment) || '  ')) AS c_mktsegment
    FROM customer
    """
)
def standardize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  ")).alias("c_mktsegment"),
    )
    return standardize(padded, ["c_name", "absent"], ["c_mktsegment"])


@query(
    """
    SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'Unknown') AS c_mktsegment,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0.0 END AS c_acctbal
    FROM customer
    """
)
def fill_null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
    )
    return fill_defaults(holed, {"c_mktsegment": "Unknown", "c_acctbal": 0.0, "absent": 1})


@query(
    """
    WITH priced AS (
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders
    )
    SELECT o_orderkey, price,
           CASE WHEN price >= 400000 THEN 'Top' WHEN price >= 200000 THEN 'High'
                WHEN price >= 50000 THEN 'Middle' ELSE 'Low' END AS price_tier
    FROM priced
    """
)
def tier_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price")
    )
    return add_tiers(priced, [PRICE_TIER])


@query(
    """
    WITH sized AS (
        SELECT p_partkey, CASE WHEN p_size <> 7 THEN p_size END AS size FROM part
    )
    SELECT p_partkey, size,
           CASE WHEN size < 10 THEN 'Small' WHEN size < 25 THEN 'Medium'
                WHEN size < 40 THEN 'Large' ELSE 'Huge' END AS size_tier
    FROM sized
    """
)
def tier_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") != 7, F.col("p_size")).alias("size")
    )
    return add_tiers(sized, [SIZE_TIER])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_tax, l_discount, l_tax - l_discount AS tax_gap
    FROM lineitem
    """
)
def gap_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_tax", "l_discount"
    )
    return add_gaps(lines, [Gap("tax_gap", high="l_tax", low="l_discount")])


@query(
    """
    SELECT s_suppkey, s_name, TIMESTAMP '2024-01-01 00:00:00' AS processed_at, '1.0' AS version
    FROM supplier
    """
)
def audit_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_audit(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "1.0", at=AT)


_CLEAN_CUSTOMERS = """
    WITH filled AS (
        SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS customer_name,
               coalesce(nullif(upper(c_mktsegment), 'MACHINERY'), 'UNKNOWN') AS segment,
               c_nationkey AS nation_key,
               CASE WHEN c_custkey % 10 = 0 THEN 0.0 ELSE c_acctbal END AS balance,
               CAST(trunc(c_acctbal) AS INTEGER) + 1 AS credit_limit
        FROM customer
    )
    SELECT *,
           CASE WHEN balance >= 7500 THEN 'Gold' WHEN balance >= 2500 THEN 'Silver'
                WHEN balance >= 0 THEN 'Basic' ELSE 'Debt' END AS balance_tier,
           credit_limit - balance AS headroom,
           TIMESTAMP '2024-01-01 00:00:00' AS processed_at, '1.0' AS version
    FROM filled
"""


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as untidy text: padded names, holes, numbers that do not parse."""
    balance = F.col("c_acctbal")
    unreadable = F.col("c_custkey") % 10 == 0
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.nullif(F.lower("c_mktsegment"), F.lit("machinery")).alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.when(unreadable, F.lit("n/a")).otherwise(balance.cast("string")).alias("balance_text"),
        (F.when(balance >= 0, F.floor(balance)).otherwise(F.ceil(balance)) + 1)
        .cast("double")
        .cast("string")
        .alias("limit_text"),
        F.lit("dropped").alias("c_comment"),
    )


@query(_CLEAN_CUSTOMERS)
def clean_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_customers(spark, sf_dir), CUSTOMERS, at=AT)


@query(
    f"""
    SELECT balance_tier, count(customer_id) AS customers, round(avg(balance), 1) AS avg_balance,
           round(sum(balance), 0) AS total_balance, max(credit_limit) AS max_limit
    FROM ({_CLEAN_CUSTOMERS}) GROUP BY balance_tier
    """
)
def clean_and_summarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(
        clean_chain(spark, sf_dir),
        ["balance_tier"],
        [
            Measure("customers", "count", "customer_id"),
            Measure("avg_balance", "avg", "balance", 1),
            Measure("total_balance", "sum", "balance", 0),
            Measure("max_limit", "max", "credit_limit"),
        ],
    )


_KEPT_LINES = """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus
    FROM lineitem
    WHERE l_quantity BETWEEN 5 AND 45 AND l_returnflag IS NOT NULL AND length(l_returnflag) > 0
      AND nullif(l_linestatus, 'F') = 'O'
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus",
    )


@query(_KEPT_LINES)
def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_failing(_lines(spark, sf_dir), LINE_RULES)


@query(_KEPT_LINES)
def expect_drop_and_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce(_lines(spark, sf_dir), LINE_RULES, "line_rules")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus
    FROM lineitem
    """
)
def expect_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    warnings = [r for r in LINE_RULES if r.action == "warn"]
    return enforce(_lines(spark, sf_dir), warnings, "line_warnings")


@query(
    """
    WITH outcome AS (
        SELECT 'valid_quantity' AS rule, 'drop' AS action,
               l_quantity BETWEEN 5 AND 45 AS ok FROM lineitem
        UNION ALL
        SELECT 'valid_flag', 'drop', l_returnflag IS NOT NULL AND length(l_returnflag) > 0
        FROM lineitem
        UNION ALL
        SELECT 'open_line', 'drop', nullif(l_linestatus, 'F') = 'O' FROM lineitem
        UNION ALL
        SELECT 'discount_covers_tax', 'warn', l_discount >= l_tax FROM lineitem
        UNION ALL
        SELECT 'not_returned', 'warn', nullif(l_returnflag, 'A') <> 'R' FROM lineitem
    )
    SELECT rule, action, count(*) FILTER (WHERE ok) AS passed,
           count(*) - count(*) FILTER (WHERE ok) AS failed
    FROM outcome GROUP BY rule, action
    """
)
def expect_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_lines(spark, sf_dir), LINE_RULES)


@query(
    """
    WITH counted AS (
        SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity BETWEEN 5 AND 45) AS a,
               count(*) FILTER (WHERE l_returnflag IS NOT NULL AND length(l_returnflag) > 0) AS b,
               count(*) FILTER (WHERE nullif(l_linestatus, 'F') = 'O') AS c,
               count(*) FILTER (WHERE l_discount >= l_tax) AS d,
               count(*) FILTER (WHERE nullif(l_returnflag, 'A') <> 'R') AS e
        FROM lineitem
    )
    SELECT unnest(['rows', 'valid_quantity', 'valid_flag', 'open_line', 'discount_covers_tax',
                   'not_returned']) AS rule,
           unnest([n, n - a, n - b, n - c, n - d, n - e]) AS violations
    FROM counted
    """
)
def expect_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the counters of one pass saw, once the rows that passed are written."""
    seen = Observation("line_rules")
    rows = enforce(_lines(spark, sf_dir), LINE_RULES, seen)
    rows.write.format("noop").mode("overwrite").save()
    return counter_rows(spark, seen.get)
