"""Rules: which rows stay, what is counted."""

import pytest
from pyspark.sql import Observation

from terrace.operators.quality import drop_failing, enforce, quality_report
from terrace.plans.players import RULES
from terrace.profile import Rule

GOOD = dict(
    player_id=1, overall_rating=80, age=25, player_name="A", fifa_version=20,
    market_value_eur=1.0, weekly_wage_eur=1.0, rating_gap=1,
)
SCHEMA = (
    "player_id int, overall_rating int, age int, player_name string, fifa_version int, "
    "market_value_eur double, weekly_wage_eur double, rating_gap int"
)
CASES = [
    ({}, True),
    ({"player_id": None}, False),
    *[({"overall_rating": v}, ok) for v, ok in ((0, False), (1, True), (99, True), (100, False), (None, False))],
    *[({"age": v}, ok) for v, ok in ((14, False), (15, True), (50, True), (51, False), (None, False))],
    *[({"player_name": v}, ok) for v, ok in ((None, False), ("", False), ("x", True))],
    *[({"fifa_version": v}, ok) for v, ok in ((14, False), (15, True), (22, True), (23, False), (None, False))],
    ({"market_value_eur": -1.0}, True),
    ({"weekly_wage_eur": -1.0}, True),
    ({"rating_gap": -2}, True),
    ({"rating_gap": None}, True),
]


@pytest.fixture(scope="module")
def candidates(spark):
    data = [tuple((GOOD | change).values()) for change, _ in CASES]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("change, kept", CASES)
def test_boundaries(spark, change, kept):
    row = spark.createDataFrame([tuple((GOOD | change).values())], SCHEMA)
    assert drop_failing(row, RULES).count() == int(kept)


def test_counters_see_every_row_and_each_rule_alone(candidates):
    seen = Observation("counts")
    kept = enforce(candidates, RULES, seen).collect()
    assert len(kept) == sum(ok for _, ok in CASES)
    assert seen.get == {
        "rows": len(CASES),
        "valid_player_id": 1,
        "valid_overall_rating": 3,
        "valid_age": 3,
        "valid_player_name": 2,
        "valid_fifa_version": 3,
        "non_negative_market_value": 1,
        "non_negative_wage": 1,
        "non_negative_rating_gap": 2,
    }


def test_report_adds_up_and_agrees_with_the_counters(candidates):
    seen = Observation("again")
    enforce(candidates, RULES, seen).count()
    report = {r["rule"]: r for r in quality_report(candidates, RULES).collect()}
    assert list(report) == [r.name for r in RULES]
    for rule in RULES:
        line = report[rule.name]
        assert line["action"] == rule.action
        assert line["passed"] + line["failed"] == len(CASES)
        assert line["failed"] == seen.get[rule.name]


def test_unknown_action_is_refused():
    with pytest.raises(ValueError, match="action"):
        Rule("r", "true", "fail")
