"""Change history in both modes, and its equality when large ids are cut."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.history import change_history
from terrace.operators.neighbours import PIECE, cut_points, with_piece
from terrace.plans.players import transfer_history

PATTERNS = {
    1: [("A", 15), ("A", 16)],
    2: [("A", 15), ("A", 16), ("B", 17), ("B", 18)],
    3: [("A", 15), ("B", 16), ("A", 17)],
    4: [("A", 15), ("A", 17)],
    5: [("C", 15)],
    6: [("A", 15), ("B", 16)],
    7: [("A", 15), (None, 16), ("A", 17)],
}
EXPECTED = {
    "appearance": {
        1: [("A", 2015, 2016, False)],
        2: [("A", 2015, 2016, False), ("B", 2017, 2018, False)],
        3: [("A", 2015, 2016, False), ("B", 2016, 2017, False), ("A", 2017, None, True)],
        4: [("A", 2015, 2017, False)],
        5: [("C", 2015, None, True)],
        6: [("A", 2015, 2016, False), ("B", 2016, None, True)],
        7: [("A", 2015, 2016, False), ("A", 2017, None, True)],
    },
    "change": {
        1: [("A", 2015, None, True)],
        2: [("A", 2015, 2017, False), ("B", 2017, None, True)],
        3: [("A", 2015, 2016, False), ("B", 2016, 2017, False), ("A", 2017, None, True)],
        4: [("A", 2015, None, True)],
        5: [("C", 2015, None, True)],
        6: [("A", 2015, 2016, False), ("B", 2016, None, True)],
        7: [("A", 2015, 2017, False), ("A", 2017, None, True)],
    },
}


@pytest.fixture(scope="module")
def appearances(spark):
    data = [
        (player, "P", "X", club, "L", 80, 1.0, edition)
        for player, seen in PATTERNS.items()
        for club, edition in seen
    ]
    random.Random(3).shuffle(data)
    return spark.createDataFrame(
        data,
        "player_id int, player_name string, nationality string, club_name string, "
        "league_name string, overall_rating int, market_value_eur double, fifa_version int",
    )


@pytest.mark.parametrize("closing", EXPECTED)
@pytest.mark.parametrize("player", PATTERNS)
def test_patterns(appearances, closing, player):
    found = transfer_history(appearances.where(F.col("player_id") == player), closing)
    periods = [
        (r["club_name"], r["start_year"], r["end_year"], r["is_current"])
        for r in found.orderBy("start_year").collect()
    ]
    assert periods == EXPECTED[closing][player]


def test_published_schema(appearances):
    found = transfer_history(appearances)
    assert found.columns[-3:] == ["start_year", "end_year", "is_current"]
    assert [found.schema[c].dataType for c in found.columns[-3:]] == [
        T.IntegerType(), T.IntegerType(), T.BooleanType(),
    ]


def test_unknown_mode_is_refused(appearances):
    with pytest.raises(ValueError, match="closing"):
        transfer_history(appearances, "never")


def brute_force(data, closing):
    """Row by row over Python lists: (id, order, tie, value) in, periods out."""
    found, by_id = [], {}
    for row in data:
        by_id.setdefault(row[0], []).append(row)
    for seen in by_id.values():
        seen.sort(key=lambda r: ((r[1] is not None, r[1] or 0), r[2]))
        changes = []
        for i, row in enumerate(seen):
            before = seen[i - 1][3] if i else None
            if before is None or (row[3] is not None and row[3] != before):
                changes.append(i)
        for n, i in enumerate(changes):
            if closing == "appearance":
                following = seen[i + 1][1] if i + 1 < len(seen) else None
            else:
                following = seen[changes[n + 1]][1] if n + 1 < len(changes) else None
            found.append((*seen[i], seen[i][1], following, following is None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("closing", ["appearance", "change"])
@pytest.mark.parametrize("per_piece", [40, 7, 1_000_000])
def test_cut_ids_give_the_same_history(spark, closing, per_piece):
    """One id holds a third of all rows; nulls and equal order values included."""
    rng = random.Random(11)
    data = []
    for tie in range(900):
        owner = rng.choice([7, None, rng.randrange(100, 160)])
        order = rng.choice([None, rng.randrange(200)] + [rng.randrange(200)] * 8)
        data.append((owner, order, tie, rng.choice(["a", "b", None])))
    df = spark.createDataFrame(data, "id int, at int, tie int, value string").repartition(5)
    found = change_history(
        df, ["id"], "at", "value", closing, ties=["tie"], rows_per_piece=per_piece
    )
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_force(data, closing)


def test_only_large_ids_are_cut(spark):
    data = [(1, i) for i in range(1000)] + [(2, i) for i in range(50)]
    df = spark.createDataFrame(data, "id int, at int")
    cuts = cut_points(df, ["id"], "at", rows_per_piece=100)
    sizes = with_piece(df, ["id"], "at", (), cuts).groupBy("id", PIECE).count().collect()
    small = [r for r in sizes if r["id"] == 2]
    large = [r["count"] for r in sizes if r["id"] == 1]
    assert [(r[PIECE], r["count"]) for r in small] == [(0, 50)]
    assert sum(large) == 1000 and len(large) == 10 and max(large) <= 110


def test_rows_are_spread_over_ordered_pieces(spark):
    df = spark.range(20_000).select(F.lit(1).alias("id"), F.col("id").alias("at"))
    cuts = cut_points(df, ["id"], "at", rows_per_piece=100)
    pieces = with_piece(df, ["id"], "at", (), cuts).groupBy(PIECE).agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.count("*").alias("n")
    )
    found = sorted(tuple(r) for r in pieces.collect())
    assert [p for p, *_ in found] == list(range(200))
    assert all(low <= high < following for (_, low, high, _), (_, following, *_) in zip(found, found[1:]))
    assert max(n for *_, n in found) <= 120


@pytest.mark.parametrize("closing", ["appearance", "change"])
def test_sampled_cuts_give_the_same_history(spark, closing):
    df = spark.range(30_000).select(
        (F.col("id") % 3 == 0).cast("int").alias("owner"),
        F.col("id").alias("at"),
        (F.xxhash64("id") % 3).alias("value"),
    )
    whole = change_history(df, ["owner"], "at", "value", closing, rows_per_piece=None)
    cut = change_history(df, ["owner"], "at", "value", closing, rows_per_piece=1_000)
    assert PIECE in cut._jdf.queryExecution().toString()
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()


@pytest.mark.parametrize("closing", ["appearance", "change"])
def test_cut_ids_need_two_shuffles_and_one_scan(spark, tmp_path, closing):
    spark.range(3_000).selectExpr("id % 2 AS owner", "id AS at", "id % 5 AS value").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = change_history(df, ["owner"], "at", "value", closing, rows_per_piece=100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 1


def test_text_order_and_equal_order_values_are_cut(spark):
    df = spark.range(2_000).select(
        F.lit(1).alias("id"), F.lpad((F.col("id") % 7).cast("string"), 3, "0").alias("at"), F.col("id").alias("tie"),
        (F.xxhash64("id") % 2).alias("value"),
    )
    cuts = cut_points(df, ["id"], "at", ["tie"], rows_per_piece=100)
    sizes = [r["count"] for r in with_piece(df, ["id"], "at", ["tie"], cuts).groupBy(PIECE).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 110
    for closing in ("appearance", "change"):
        whole = change_history(df, ["id"], "at", "value", closing, ties=["tie"], rows_per_piece=None)
        cut = change_history(df, ["id"], "at", "value", closing, ties=["tie"], rows_per_piece=100)
        assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()


def test_touching_periods_and_one_current_row(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    found = change_history(events, ["user_id"], "ts", "event_type", "change")
    per_user = found.groupBy("user_id").agg(F.count_if("is_current").alias("current")).collect()
    assert all(r["current"] == 1 for r in per_user)
    ends = found.where("end_year IS NOT NULL").select("user_id", F.col("end_year").alias("at"))
    starts = found.select("user_id", F.col("start_year").alias("at"))
    assert ends.exceptAll(starts).isEmpty()
