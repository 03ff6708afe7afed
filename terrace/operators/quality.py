"""Data-quality rules: drop failing rows, count violations, report both.

All rules see the same input row.  A rule passes only when it is TRUE; a null
outcome is a violation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.functions.columns import holds
from terrace.profile import Rule


def drop_failing(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep the rows that pass every drop rule.

    The filter is the bare AND of the predicates (a filter removes null outcomes
    by itself), so comparisons still reach the Parquet scan.
    """
    for rule in rules:
        if rule.action == "drop":
            df = df.where(rule.predicate)
    return df


def enforce(
    df: DataFrame, rules: Sequence[Rule], name: str | Observation = "rules"
) -> DataFrame:
    """``drop_failing`` plus one violation counter per rule, in the same pass.

    Metrics are ``rows`` and the name of each rule.  A batch job passes an
    ``Observation`` and reads it after the write; a stream passes a name and reads
    ``observedMetrics`` from the query progress.  Counting needs every row, so
    nothing can be pushed into the scan; use ``drop_failing`` where no counts are
    wanted.
    """
    counters = [F.count_if(~holds(r.predicate)).alias(r.name) for r in rules]
    return drop_failing(df.observe(name, F.count(F.lit(1)).alias("rows"), *counters), rules)


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rule, action, passed, failed: all rules from one scan and one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(holds(r.predicate)).alias(f"passed_{i}") for i, r in enumerate(rules)],
    )
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            F.col(f"passed_{i}").alias("passed"),
            (F.col("rows") - F.col(f"passed_{i}")).alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def counter_rows(spark: SparkSession, counters: Mapping[str, int]) -> DataFrame:
    """rule and violations: what an ``Observation`` or a query's progress has counted, as rows."""
    pairs = sorted(counters.items())
    return spark.createDataFrame(pairs, "rule string, violations long")
