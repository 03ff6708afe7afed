"""The players pipeline over player rows that are derived from the whole ``orders`` table.

A customer plays the player and the year of an order the edition, so the rows have
the columns, holes, padding and rule violations of the real raw files.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.plans import players
from terrace.plans.registry import query, table
from terrace.session import scratch_path
from terrace.sinks.keyed import BUCKET

AT = datetime(2024, 1, 1)
FIRST_YEAR_TO_EDITION = 1977
LATER = 19


def raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One untidy row per customer and order year, all text but edition and time."""
    yearly = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.max("o_totalprice").alias("highest"),
            F.min("o_totalprice").alias("lowest"),
            F.min("o_orderpriority").alias("priority"),
            F.max("o_orderstatus").alias("status"),
        )
    )
    customer, year = F.col("o_custkey"), F.col("year")
    overall = 39 + customer % 61
    text = {
        "sofifa_id": customer,
        "short_name": F.when(customer % 50 == 0, "  ").otherwise(
            F.concat(F.lit(" P"), customer, F.lit(" "))
        ),
        "long_name": F.concat(F.lit("Player "), customer),
        "age": 13 + customer % 36 + year - 1992,
        "height_cm": 160 + customer % 40,
        "weight_kg": F.when(customer % 7 == 0, "unknown").otherwise((60 + customer % 40).cast("string")),
        "nationality": F.concat(F.lit("Nation "), customer % 25),
        "club": F.when(F.col("priority") == "5-LOW", None).otherwise(
            F.concat(F.lit(" "), "priority")
        ),
        "league_name": F.nullif("status", F.lit("P")),
        "overall": overall,
        "potential": overall + F.col("orders") % 7 - 1,
        "value_eur": F.col("highest") * 150,
        "wage_eur": F.when(F.col("orders") > 1, F.col("lowest") / 100),
        "player_positions": F.lit("RW, ST"),
        "preferred_foot": F.when(customer % 3 == 0, " left").otherwise("right "),
        "international_reputation": F.lit("1"),
        "release_clause_eur": F.lit(None),
        "source_file": F.lit("players.csv"),
        "dob": F.lit("dropped"),
    }
    return yearly.select(
        *[value.cast("string").alias(name) for name, value in text.items()],
        (year - FIRST_YEAR_TO_EDITION).alias("fifa_version"),
        F.lit(AT).alias("ingested_at"),
    )


def silver_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that pass the drop rules, with all rules counted on the way.

    The counters keep the filter above the casts, so each cast runs once per row.
    """
    return players.validated(players.cleaned(raw_players(spark, sf_dir), at=AT))


def passing_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows without counters: a filter on the edition reaches the scan of ``orders``."""
    return players.passing(players.cleaned(raw_players(spark, sf_dir), at=AT))


_SILVER = """
    WITH yearly AS (
        SELECT o_custkey AS customer, year(o_orderdate) AS y, count(*) AS orders,
               max(o_totalprice) AS highest, min(o_totalprice) AS lowest,
               min(o_orderpriority) AS priority, max(o_orderstatus) AS status
        FROM orders GROUP BY ALL
    ), typed AS (
        SELECT CAST(customer AS INTEGER) AS player_id,
               CASE WHEN customer % 50 = 0 THEN '' ELSE 'P' || customer END AS player_name,
               'Player ' || customer AS player_full_name,
               CAST(13 + customer % 36 + y - 1992 AS INTEGER) AS age,
               CAST(160 + customer % 40 AS INTEGER) AS height_cm,
               CASE WHEN customer % 7 <> 0 THEN CAST(60 + customer % 40 AS INTEGER) END AS weight_kg,
               'Nation ' || (customer % 25) AS nationality,
               CASE WHEN priority = '5-LOW' THEN 'Free Agent' ELSE priority END AS club_name,
               CASE WHEN status = 'P' THEN 'Unknown' ELSE status END AS league_name,
               CAST(39 + customer % 61 AS INTEGER) AS overall_rating,
               CAST(38 + customer % 61 + orders % 7 AS INTEGER) AS potential_rating,
               highest * 150 AS market_value_eur,
               CASE WHEN orders > 1 THEN lowest / 100 ELSE 0.0 END AS weekly_wage_eur,
               'RW, ST' AS positions,
               CASE WHEN customer % 3 = 0 THEN 'LEFT' ELSE 'RIGHT' END AS preferred_foot,
               1 AS international_reputation, CAST(0.0 AS DOUBLE) AS release_clause_eur,
               CAST(y - 1977 AS INTEGER) AS fifa_version, 'players.csv' AS source_file,
               TIMESTAMP '2024-01-01 00:00:00' AS ingested_at
        FROM yearly
    ), silver AS (
        SELECT *,
               CASE WHEN market_value_eur >= 50000000 THEN 'World Class'
                    WHEN market_value_eur >= 20000000 THEN 'Elite'
                    WHEN market_value_eur >= 5000000 THEN 'Good'
                    WHEN market_value_eur >= 1000000 THEN 'Average' ELSE 'Budget' END AS value_category,
               CASE WHEN age < 21 THEN 'U21 Prospect' WHEN age < 25 THEN 'Young'
                    WHEN age < 30 THEN 'Prime' WHEN age < 33 THEN 'Experienced'
                    ELSE 'Veteran' END AS age_group,
               potential_rating - overall_rating AS rating_gap,
               TIMESTAMP '2024-01-01 00:00:00' AS processed_at, '1.0' AS silver_version
        FROM typed
        WHERE overall_rating BETWEEN 1 AND 99 AND age BETWEEN 15 AND 50
          AND length(player_name) > 0 AND fifa_version BETWEEN 15 AND 22
    )
"""

_NATIONS = """
    SELECT nationality, fifa_version, count(*) AS player_count,
           avg(overall_rating) AS avg_rating, max(overall_rating) AS max_rating
    FROM silver GROUP BY nationality, fifa_version
"""
_CLUBS = """
    SELECT club_name, league_name, fifa_version, count(player_id) AS squad_size,
           round(avg(overall_rating), 1) AS avg_squad_rating,
           round(sum(market_value_eur), 0) AS total_squad_value,
           round(sum(weekly_wage_eur), 0) AS total_weekly_wages,
           max(overall_rating) AS best_player_rating, round(avg(age), 1) AS avg_squad_age,
           max(processed_at) AS last_updated
    FROM silver GROUP BY club_name, league_name, fifa_version
"""
_HISTORY = """
    SELECT player_id, player_name, nationality, club_name, league_name, overall_rating,
           market_value_eur, fifa_version, fifa_version + 2000 AS start_year,
           next_version + 2000 AS end_year, next_version IS NULL AS is_current
"""


@query(f"{_SILVER} SELECT * FROM silver")
def player_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.rankings(silver_players(spark, sf_dir))


@query(f"{_SILVER} {_NATIONS}")
def nation_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.nation_performance(silver_players(spark, sf_dir))


@query(f"{_SILVER} {_CLUBS}")
def club_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.club_analysis(silver_players(spark, sf_dir))


@query(
    f"""
    {_SILVER}
    SELECT age_group, fifa_version, count(player_id) AS player_count,
           round(avg(overall_rating), 1) AS avg_rating,
           round(avg(potential_rating), 1) AS avg_potential,
           round(avg(market_value_eur), 0) AS avg_value,
           round(avg(rating_gap), 1) AS avg_rating_gap, max(processed_at) AS last_updated
    FROM silver GROUP BY age_group, fifa_version
    """
)
def age_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.age_analysis(silver_players(spark, sf_dir))


@query(
    f"""
    {_SILVER}, seen AS (
        SELECT *, lag(club_name) OVER w AS before, lead(fifa_version) OVER w AS next_version
        FROM silver WINDOW w AS (PARTITION BY player_id ORDER BY fifa_version)
    )
    {_HISTORY} FROM seen WHERE before IS NULL OR club_name <> before
    """
)
def transfer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.transfer_history(silver_players(spark, sf_dir))


@query(
    f"""
    {_SILVER}, seen AS (
        SELECT *, lag(club_name) OVER (PARTITION BY player_id ORDER BY fifa_version) AS before
        FROM silver
    ), changes AS (
        SELECT *, lead(fifa_version) OVER (PARTITION BY player_id ORDER BY fifa_version) AS next_version
        FROM seen WHERE before IS NULL OR club_name <> before
    )
    {_HISTORY} FROM changes
    """
)
def transfer_history_touching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.transfer_history(silver_players(spark, sf_dir), "change")


@query(
    f"""
    {_SILVER} SELECT player_name, nationality, club_name, overall_rating FROM silver
    WHERE fifa_version = 20 ORDER BY overall_rating DESC, player_name, player_id LIMIT 10
    """
)
def top_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.top_players(passing_players(spark, sf_dir), 20)


@query(
    f"""
    {_SILVER}, nations AS ({_NATIONS})
    SELECT nationality, player_count, avg_rating, max_rating FROM nations
    WHERE fifa_version = 20 ORDER BY player_count DESC, nationality LIMIT 10
    """
)
def top_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = players.nation_performance(passing_players(spark, sf_dir))
    return players.top_nations(nations, 20)


@query(
    f"""
    {_SILVER}, clubs AS ({_CLUBS})
    SELECT club_name, total_squad_value FROM clubs
    WHERE fifa_version = 20 ORDER BY total_squad_value DESC, club_name, league_name LIMIT 10
    """
)
def top_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    clubs = players.club_analysis(passing_players(spark, sf_dir))
    return players.top_clubs(clubs, 20)


@query(
    """
    WITH yearly AS (
        SELECT nullif(max(o_orderstatus), 'P') AS league_name FROM orders
        WHERE year(o_orderdate) = 1997 GROUP BY o_custkey
    )
    SELECT DISTINCT league_name, count(*) AS "count" FROM yearly
    GROUP BY league_name ORDER BY "count" DESC, league_name LIMIT 10
    """
)
def top_leagues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return players.top_leagues(raw_players(spark, sf_dir), 20)


def _lake(spark: SparkSession, sf_dir: str) -> players.PlayersLake:
    """The lake after two deliveries of CSV files with different headers and two runs.

    The earlier editions lack one column and use the earlier spellings.
    """
    root, name = scratch_path(spark, "lake"), uuid.uuid4().hex[:12]
    lake = players.PlayersLake(f"{root}/in", root, f"bronze_{name}", f"silver_{name}", f"gold_{name}")
    rows = raw_players(spark, sf_dir).drop("source_file", "ingested_at")
    early = rows.where(f"fifa_version < {LATER}").drop("international_reputation")
    later = rows.where(f"fifa_version >= {LATER}").withColumnsRenamed(
        {"nationality": "nationality_name", "club": "club_name"}
    )
    for delivery in (early, later):
        # Editions arrive as folders named like the yearly files.
        file = F.concat(F.lit("players_"), "fifa_version", F.lit(".csv"))
        named = delivery.withColumn("file", file).drop("fifa_version").hint("rebalance", "file")
        named.write.mode("append").partitionBy("file").option("header", True).csv(f"{root}/in")
        lake.run(spark)
    return lake


_GROWN = f"""
    SELECT * REPLACE (CASE WHEN fifa_version >= {LATER} THEN 1 END AS international_reputation)
    FROM silver
"""


def _at(rows: DataFrame) -> DataFrame:
    """Times and files of this run, which no other run repeats, as fixed values."""
    fixed = {"ingested_at": AT, "processed_at": AT, "last_updated": AT, "source_file": "players.csv"}
    return rows.withColumns({c: F.lit(v) for c, v in fixed.items() if c in rows.columns})


@query(f"{_SILVER} {_CLUBS}")
def players_lake_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The club table by name, after two runs of the whole lake."""
    return _at(spark.table(f"{_lake(spark, sf_dir).gold_layer}.{players.CLUBS}"))


@query(f"{_SILVER} {_GROWN}")
def lake_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at(spark.table(f"{_lake(spark, sf_dir).gold_layer}.{players.RANKINGS}"))


@query(f"{_SILVER} {_GROWN}")
def lake_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at(spark.table(f"{_lake(spark, sf_dir).silver_layer}.{players.SILVER}"))


@query(f"{_SILVER} {_NATIONS}")
def lake_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_lake(spark, sf_dir).gold_layer}.{players.NATIONS}")


@query(
    f"""
    {_SILVER}, seen AS (
        SELECT *, lag(club_name) OVER w AS before, lead(fifa_version) OVER w AS next_version
        FROM silver WINDOW w AS (PARTITION BY player_id ORDER BY fifa_version)
    )
    {_HISTORY} FROM seen WHERE before IS NULL OR club_name <> before
    """
)
def lake_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_lake(spark, sf_dir).gold_layer}.{players.HISTORY}").drop(BUCKET)


@query(
    """
    SELECT CAST(year(o_orderdate) - 1977 AS INTEGER) AS fifa_version,
           count(DISTINCT o_custkey) AS row_count
    FROM orders GROUP BY 1
    """
)
def lake_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows per edition, read from the raw table by name."""
    raw = spark.table(f"{_lake(spark, sf_dir).bronze_layer}.{players.RAW}")
    return raw.groupBy("fifa_version").agg(F.count("*").alias("row_count"))


@query(
    f"""
    {_SILVER}, counted AS (
        SELECT 'nation_performance' AS table_name, fifa_version, count(DISTINCT nationality) AS row_count
        FROM silver GROUP BY fifa_version
        UNION ALL
        SELECT 'club_analysis', fifa_version, count(DISTINCT (club_name, league_name)) FROM silver GROUP BY fifa_version
        UNION ALL
        SELECT 'age_analysis', fifa_version, count(DISTINCT age_group) FROM silver GROUP BY fifa_version
        UNION ALL
        SELECT 'player_rankings', fifa_version, count(*) FROM silver GROUP BY fifa_version
    )
    SELECT * FROM counted
    """
)
def lake_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per edition of every published table of one lake."""
    lake = _lake(spark, sf_dir)
    found = [
        spark.table(f"{lake.gold_layer}.{name}")
        .groupBy("fifa_version")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "fifa_version", "row_count")
        for name in (players.NATIONS, players.CLUBS, players.AGES, players.RANKINGS)
    ]
    return reduce(DataFrame.unionAll, found)
