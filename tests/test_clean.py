"""The cleaning chain, step by step and as a whole, on the players profile."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.columns import number_in_text, tolerant_cast
from terrace.operators.clean import (
    add_gaps,
    add_tiers,
    apply_casts,
    clean,
    fill_defaults,
    standardize,
)
from terrace.operators.project import add_audit, rename, select_available, select_strict
from terrace.plans.players import (
    AGE_TIER,
    ALIASES,
    DEFAULTS,
    PROFILE,
    RATING_GAP,
    RENAMES,
    TRIMMED,
    UPPERED,
    VALUE_TIER,
)
from terrace.profile import Aliased, Tier

# Three rows of our own: one tidy, one with padding and holes, one with text where numbers belong.
RAW = {
    "sofifa_id": ("7", "4001", "88"),
    "short_name": ("Ilse Maro", "  T. Okoye  ", "Wen"),
    "long_name": ("Ilse Maro", "Tunde Okoye", None),
    "age": ("19", "28.0", "unknown"),
    "height_cm": ("171", None, "180"),
    "weight_kg": (None, "77", "seventy"),
    "nationality": (None, "  Westmark", "Ostra "),
    "club": ("Quarry Rovers ", None, None),
    "league_name": ("Second Division", None, " Cup League"),
    "overall": ("64", "77", None),
    "potential": ("82", "76", "70"),
    "value_eur": ("1500000", "20000000", "-"),
    "wage_eur": (None, "48500.5", "900"),
    "player_positions": ("GK", "CB, LB", "CM"),
    "preferred_foot": ("Left", " right", None),
    "international_reputation": ("1", "2", "1"),
    "release_clause_eur": ("3100000", None, None),
    "fifa_version": ("17", "18", "18"),
    "source_file": ("a.csv", "b.csv", "b.csv"),
    "ingested_at": ("2023-03-03", "2023-03-04", "2023-03-04"),
    "shirt": ("1", "5", "8"),
}


def rows(spark, columns):
    """A DataFrame from column values; a pair (type, values) fixes the type."""
    schema, data = [], []
    for name, values in columns.items():
        kind = "string"
        if isinstance(values, tuple) and values and isinstance(values[0], T.DataType):
            kind, values = values[0], values[1]
        schema.append(T.StructField(name, T.StringType() if kind == "string" else kind))
        data.append(values)
    return spark.createDataFrame(list(zip(*data)), T.StructType(schema))


@pytest.fixture(scope="module")
def raw(spark):
    return rows(spark, RAW)


@pytest.fixture(scope="module")
def chained(spark):
    columns = {k: v for k, v in RAW.items() if k != "shirt"}
    found = clean(rows(spark, columns), PROFILE, select=None)
    return found.columns, {r["player_id"]: r for r in found.collect()}


# --- select -----------------------------------------------------------------

WANTED = ("overall", "age", "short_name")


def test_strict_select_drops_extras_and_keeps_order(raw):
    assert select_strict(raw, WANTED).columns == list(WANTED)


def test_strict_select_keeps_rows_and_values(raw):
    found = [tuple(r) for r in select_strict(raw, WANTED).collect()]
    assert found == list(zip(*(RAW[c] for c in WANTED), strict=True))


def test_strict_select_names_the_missing_column(raw):
    with pytest.raises(ValueError, match="league_name"):
        select_strict(raw.drop("league_name"), ["age", "league_name"])


def test_available_select_skips_absent_columns(raw):
    assert select_available(raw, ["shirt", "nowhere", "club"]).columns == ["shirt", "club"]


def test_available_select_keeps_every_spelling(raw):
    both = raw.withColumn("club_name", F.lit("x"))
    found = select_available(both, PROFILE.required, PROFILE.aliases).columns
    assert {"club", "club_name"} <= set(found) and "shirt" not in found


# --- casts ------------------------------------------------------------------


TYPES = {"integer": T.IntegerType(), "double": T.DoubleType()}


@pytest.mark.parametrize("column, kind", PROFILE.casts.items())
def test_cast_types(raw, column, kind):
    assert apply_casts(raw, PROFILE.casts).schema[column].dataType == TYPES[kind]


def test_cast_values(raw):
    found = [tuple(r) for r in apply_casts(raw, PROFILE.casts).select("age", "wage_eur", "weight_kg").collect()]
    assert found == [(19, None, None), (28, 48500.5, 77), (None, 900.0, None)]


def test_cast_ignores_absent_columns(spark):
    found = apply_casts(rows(spark, {"age": ("31",), "x": ("y",)}), PROFILE.casts)
    assert found.columns == ["age", "x"] and tuple(found.first()) == (31, "y")


@pytest.mark.parametrize("text", ["-", "seventy", "12 kg"])
def test_cast_of_other_text_is_null(spark, text):
    assert apply_casts(rows(spark, {"height_cm": (text,)}), PROFILE.casts).first()[0] is None


TEXTS = [
    "x", "", " ", " 91 ", "91.0", "91.7", "-91.7", "3000000000", "1e2", "1.5d", ".5", "-.5", "5.",
    "+7", "+", "-", ".", "+.", "NaN", "inf", "-Infinity", "infinit", "1e400", "\t12\n", "1 2", "n/a",
    "12L", "1f", "2147483648.5", "00012", "1.2.3", "1e", "e5", "9223372036854775808", None,
]


@pytest.mark.parametrize("to", ["int", "bigint", "double"])
def test_cast_of_text_equals_the_plain_cast_without_ansi(spark, to):
    texts = rows(spark, {"t": tuple(TEXTS)})
    ours = [repr(r[0]) for r in texts.select(tolerant_cast(F.col("t"), to)).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = [repr(r[0]) for r in texts.select(F.col("t").cast(to)).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert ours == plain


def test_cast_of_numbers_does_not_go_through_text(spark):
    numbers = rows(spark, {"n": (T.DoubleType(), (1.0e7, 91.7, 3.0e9))})
    found = [r[0] for r in apply_casts(numbers, {"n": "int"}).collect()]
    assert found == [10_000_000, 91, None]


def test_number_in_text_without_a_match_is_null(spark):
    paths = rows(spark, {"p": ("/in/players_15.csv", "/in/teams.csv")})
    found = paths.select(number_in_text(F.col("p"), r"players_(\d+)\.csv")).collect()
    assert [r[0] for r in found] == [15, None]


# --- rename -----------------------------------------------------------------

@pytest.mark.parametrize("old, new", RENAMES.items())
def test_rename_replaces_the_name_and_keeps_values(raw, old, new):
    found = rename(raw, RENAMES, ALIASES)
    assert old not in found.columns
    assert [r[0] for r in found.select(new).collect()] == list(RAW[old])


def test_rename_keeps_column_positions(raw):
    found = rename(raw, RENAMES, ALIASES).columns
    names = {**RENAMES, "club": "club_name"}
    assert found == [names.get(c, c) for c in RAW]


def test_rename_of_the_early_spelling(spark):
    found = rename(rows(spark, {"club": ("A",), "nationality": ("X",)}), RENAMES, ALIASES)
    assert found.first().asDict() == {"club_name": "A", "nationality": "X"}


def test_spellings_are_merged_row_by_row(spark):
    mixed = rows(spark, {"club": ("A", None, "C"), "club_name": (None, "B", "Z")})
    found = rename(mixed, {}, (Aliased("club_name", ("club", "club_name")),))
    assert [r["club_name"] for r in found.collect()] == ["A", "B", "C"]


# --- text -------------------------------------------------------------------


@pytest.mark.parametrize("column", TRIMMED)
@pytest.mark.parametrize("text", ["  padded ", "clean"])
def test_text_is_trimmed(spark, column, text):
    found = standardize(rows(spark, {column: (text,)}), TRIMMED, UPPERED).first()[0]
    assert found == text.strip(" ")


@pytest.mark.parametrize("text, expected", [(" left ", "LEFT"), ("RIGHT", "RIGHT")])
def test_foot_is_upper_case(spark, text, expected):
    found = standardize(rows(spark, {"preferred_foot": (text,)}), TRIMMED, UPPERED)
    assert found.first()[0] == expected


def test_only_blanks_are_trimmed(spark):
    found = standardize(rows(spark, {"club_name": ("\tA ",)}), TRIMMED)
    assert found.first()[0] == "\tA"


# --- null defaults ----------------------------------------------------------


@pytest.mark.parametrize("column, default", DEFAULTS.items())
def test_null_gets_the_default(spark, column, default):
    kind = T.StringType() if isinstance(default, str) else T.DoubleType()
    found = fill_defaults(rows(spark, {column: (kind, (None,))}), DEFAULTS)
    assert found.first()[0] == default


@pytest.mark.parametrize("column, default", DEFAULTS.items())
def test_other_values_stay(spark, column, default):
    kind, value = (T.StringType(), "") if isinstance(default, str) else (T.DoubleType(), -1.0)
    found = fill_defaults(rows(spark, {column: (kind, (value,))}), DEFAULTS)
    assert found.first()[0] == value


# --- derived columns --------------------------------------------------------


def around(tier):
    """Values at, just below and just above each bound of a tier, with their labels."""
    higher = tier.op == ">="
    cases = {None: tier.otherwise}
    for bound, _ in tier.steps:
        for value in (bound - 1, bound, bound + 1):
            inside = [label for b, label in tier.steps if (value >= b if higher else value < b)]
            cases[value] = inside[0] if inside else tier.otherwise
    return list(cases.items())


@pytest.mark.parametrize(
    "tier, value, label", [(t, v, x) for t in (VALUE_TIER, AGE_TIER) for v, x in around(t)]
)
def test_tiers_at_their_bounds(spark, tier, value, label):
    number = None if value is None else float(value)
    found = add_tiers(rows(spark, {tier.source: (T.DoubleType(), (number,))}), [tier])
    assert found.first()[tier.target] == label


@pytest.mark.parametrize("high", [None, 0, 41, 99])
@pytest.mark.parametrize("low", [None, 0, 50])
def test_rating_gap(spark, high, low):
    columns = {RATING_GAP.high: (T.IntegerType(), (high,)), RATING_GAP.low: (T.IntegerType(), (low,))}
    found = add_gaps(rows(spark, columns), [RATING_GAP]).first()[RATING_GAP.target]
    assert found == (None if None in (high, low) else high - low)


def test_derived_columns_name_their_missing_input(spark):
    with pytest.raises(ValueError, match="market_value_eur"):
        add_tiers(rows(spark, {"age": ("1",)}), [VALUE_TIER])


def test_tier_with_an_unreachable_step_is_refused():
    with pytest.raises(ValueError, match="never be reached"):
        Tier("t", "s", ">=", ((1, "low"), (2, "high")), "none")


# --- audit ------------------------------------------------------------------


def test_audit_columns_are_added(spark):
    found = add_audit(rows(spark, {"player_id": ("7",)}), "1.0", version_column="silver_version")
    assert found.columns == ["player_id", "processed_at", "silver_version"]
    assert found.schema["processed_at"].dataType == T.TimestampType()


def test_audit_values(spark):
    found = add_audit(rows(spark, {"player_id": ("7",)}), "1.0").first()
    assert found["processed_at"] is not None and found["version"] == "1.0"
    assert found["player_id"] == "7"


def test_audit_with_a_fixed_time(spark):
    at = datetime(2024, 5, 6, 7, 8, 9)
    assert add_audit(rows(spark, {"player_id": ("7",)}), "1.0", at=at).first()["processed_at"] == at


# --- the whole chain --------------------------------------------------------

CHAIN = {
    7: {
        "player_name": "Ilse Maro", "club_name": "Quarry Rovers", "nationality": None,
        "weekly_wage_eur": 0.0, "release_clause_eur": 3_100_000.0, "value_category": "Average",
        "age_group": "U21 Prospect", "rating_gap": 18, "preferred_foot": "LEFT",
    },
    4001: {
        "player_name": "T. Okoye", "club_name": "Free Agent", "league_name": "Unknown",
        "nationality": "Westmark", "age": 28, "weekly_wage_eur": 48_500.5, "value_category": "Elite",
        "age_group": "Prime", "rating_gap": -1, "height_cm": None, "preferred_foot": "RIGHT",
    },
    88: {
        "player_full_name": None, "age": None, "age_group": "Veteran", "market_value_eur": 0.0,
        "value_category": "Budget", "overall_rating": None, "rating_gap": None, "preferred_foot": None,
        "league_name": "Cup League", "weight_kg": None, "silver_version": "1.0",
    },
}


def test_chain_keeps_every_row(chained):
    assert set(chained[1]) == set(CHAIN)


@pytest.mark.parametrize("player", CHAIN)
def test_chain_values(chained, player):
    assert {c: chained[1][player][c] for c in CHAIN[player]} == CHAIN[player]


def test_chain_stamps_every_row(chained):
    assert all(r["processed_at"] is not None for r in chained[1].values())


def test_strict_chain_drops_extras_and_needs_all(raw):
    assert "shirt" not in clean(raw, replace(PROFILE, aliases=()), select="strict").columns


def test_pipeline_chain_has_the_published_columns(spark):
    early = {c: ("1",) for c in PROFILE.required}
    early["extra"] = ("1",)
    assert clean(rows(spark, early), PROFILE).columns == [
        "player_id", "player_name", "player_full_name", "age", "height_cm", "weight_kg",
        "nationality", "club_name", "league_name", "overall_rating", "potential_rating",
        "market_value_eur", "weekly_wage_eur", "positions", "preferred_foot",
        "international_reputation", "release_clause_eur", "fifa_version", "source_file",
        "ingested_at", "value_category", "age_group", "rating_gap", "processed_at",
        "silver_version",
    ]


def test_unknown_select_mode_is_refused(raw):
    with pytest.raises(ValueError, match="select mode"):
        clean(raw, replace(PROFILE), select="some")
