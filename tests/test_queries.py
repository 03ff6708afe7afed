"""Every registered query agrees with its SQL, and its plan suits a large cluster."""

import re

import pytest

import __spark_entry__ as contract
from terrace.plans import players, queries_curate, queries_players
from terrace.plans.registry import all_queries, table
from tests.oracle import connect, differences

NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, sf_dir, database, name):
    found = contract.queries()[name](spark, sf_dir)
    assert differences(found, database, contract.oracle_sql()[name]) is None


def test_contract():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_and_no_cross_join_in_any_plan(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text)


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_history_needs_one_shuffle(spark, sf_dir):
    assert shuffles(queries_curate.history_appearance(spark, sf_dir)) == 1
    assert shuffles(queries_curate.history_change(spark, sf_dir)) == 1


def test_summary_aggregates_before_its_one_shuffle(spark, sf_dir):
    text = plan(queries_curate.summary_three_keys(spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("HashAggregate") == 2
    assert "partial_sum" in text


def test_scan_reads_only_what_the_summary_needs(spark, sf_dir):
    text = plan(queries_curate.summary_two_keys(spark, sf_dir))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert schema == "struct<l_quantity:double,l_returnflag:string,l_linestatus:string>"


def test_drop_rules_reach_the_scan(spark, sf_dir):
    text = plan(contract.queries()["expect_drop"](spark, sf_dir))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(l_quantity,5.0)" in pushed
    assert "LessThanOrEqual(l_quantity,45.0)" in pushed


def test_edition_filter_prunes_partitions(spark, tmp_path):
    silver = table(spark, "/root/testdata/sf0.001", "orders").selectExpr(
        "o_orderkey AS player_id", "year(o_orderdate) - 1977 AS fifa_version", "o_totalprice"
    )
    silver.write.partitionBy("fifa_version").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).where("fifa_version = 20")
    assert re.search(r"PartitionFilters: \[[^\]]*fifa_version", plan(stored))


def test_top_rows_never_sort_the_whole_input(spark, sf_dir):
    for build in (queries_curate.top_orders, queries_curate.top_groups_by_sum, queries_players.top_players):
        text = plan(build(spark, sf_dir))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_distinct_after_grouping_costs_nothing(spark, sf_dir):
    assert shuffles(queries_curate.distinct_group_top(spark, sf_dir)) == 1


def test_cleaning_is_free_of_shuffles(spark, sf_dir):
    raw = queries_players.raw_players(spark, sf_dir)
    assert shuffles(players.cleaned(raw)) == shuffles(raw)


@pytest.mark.parametrize("name", ["top_players", "top_nations", "top_clubs", "top_leagues"])
def test_edition_filter_reaches_the_scan_below_the_first_aggregate(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    lowest = text[text.rindex("Aggregate(") :]
    assert re.search(r"Filter .*year\(", lowest) and "CollectMetrics" not in text
