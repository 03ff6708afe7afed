"""Summaries, counts and top-N."""

import pytest

from terrace.operators.explore import counts_by, load_report, row_count, top_rows, top_values
from terrace.operators.summary import summarize
from terrace.plans.players import NATION_KEYS, NATION_MEASURES
from terrace.profile import Measure


@pytest.fixture(scope="module")
def ratings(spark):
    data = [("X", 15, 60), ("X", 15, 65), ("X", 16, 70), ("Y", 15, 62), ("Y", 16, None)]
    return spark.createDataFrame(data, "nationality string, fifa_version int, overall_rating int")


def test_nation_summary(ratings):
    found = sorted(tuple(r) for r in summarize(ratings, NATION_KEYS, NATION_MEASURES).collect())
    assert found == [("X", 15, 2, 62.5, 65), ("X", 16, 1, 70.0, 70), ("Y", 15, 1, 62.0, 62),
                     ("Y", 16, 1, None, None)]


def test_result_types(ratings):
    found = summarize(ratings, NATION_KEYS, NATION_MEASURES)
    assert [t for _, t in found.dtypes[2:]] == ["bigint", "double", "int"]


def test_halves_are_rounded_up(spark):
    values = spark.createDataFrame([(2.25,), (62.45,), (-2.25,)], "v double")
    for value, expected in zip(values.collect(), (2.3, 62.5, -2.3)):
        row = spark.createDataFrame([value], "v double")
        assert summarize(row, [], [Measure("r", "avg", "v", 1)]).first()[0] == expected


def test_count_of_a_column_skips_nulls(ratings):
    found = summarize(ratings, ["nationality"], [Measure("n", "count", "overall_rating")])
    assert dict(map(tuple, found.collect())) == {"X": 3, "Y": 1}


@pytest.mark.parametrize("measure", [Measure("m", "median", "v"), Measure("m", "sum")])
def test_wrong_measures_are_refused(ratings, measure):
    with pytest.raises(ValueError, match="measure"):
        summarize(ratings, ["nationality"], [measure])


def test_counts(ratings):
    assert row_count(ratings).first()[0] == 5
    assert row_count(ratings, "fifa_version = 15").first()[0] == 3
    assert [tuple(r) for r in counts_by(ratings, "fifa_version").collect()] == [(15, 3), (16, 2)]
    report = load_report(ratings, "fifa_version", "overall_rating > 60").collect()
    assert [tuple(r) for r in report] == [(15, 3, 2), (16, 2, 1)]


def test_top_rows_settle_ties_and_put_nulls_last(spark):
    data = [("b", 91), ("a", 91), ("c", None), ("d", 90), ("e", 90)]
    players = spark.createDataFrame(data, "name string, rating int")
    found = top_rows(players, 3, "rating", ["name"], ["name"]).collect()
    assert [r["name"] for r in found] == ["a", "b", "d"]
    assert [r["name"] for r in top_rows(players, 5, "rating", ["name"]).collect()][-1] == "c"


def test_top_values(ratings):
    found = top_values(ratings, "nationality", 1, "fifa_version = 15").collect()
    assert [tuple(r) for r in found] == [("X", 2)]
