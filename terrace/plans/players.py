"""The players pipeline: yearly CSV files to cleaned, summarised and historised tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from math import ceil

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrace.operators.clean import clean
from terrace.operators.explore import counts_by, load_report, row_count, top_rows, top_values
from terrace.operators.history import change_history
from terrace.operators.quality import drop_failing, enforce
from terrace.operators.summary import summarize
from terrace.profile import Aliased, Gap, Measure, Profile, Rule, Tier
from terrace.sinks.clustered import cluster
from terrace.sinks.keyed import BUCKET, KeyedTable
from terrace.sinks.tables import (
    declare_table,
    ensure_layer,
    export_external,
    grow_table,
    point_partitions,
    register_partitioned,
    set_properties,
    swap_partitions,
    use_layer,
)
from terrace.streaming.ingest import LOAD, RawTable
from terrace.streaming.jobs import keep_progress, save_rule_counts, upsert_available_now

# ---------------------------------------------------------------------------
# Names, bounds and labels that results depend on.

FILE_NAME = r"players_(\d+)\.csv"
EDITION = "fifa_version"
CENTURY = 2000

REQUIRED = (
    "sofifa_id", "short_name", "long_name", "age", "height_cm", "weight_kg",
    "nationality", "club", "league_name", "overall", "potential", "value_eur",
    "wage_eur", "player_positions", "preferred_foot", "international_reputation",
    "release_clause_eur", "fifa_version", "source_file", "ingested_at",
)
CASTS = {
    "sofifa_id": "integer",
    "age": "integer",
    "height_cm": "integer",
    "weight_kg": "integer",
    "overall": "integer",
    "potential": "integer",
    "value_eur": "double",
    "wage_eur": "double",
    "release_clause_eur": "double",
    "international_reputation": "integer",
}
RENAMES = {
    "sofifa_id": "player_id",
    "short_name": "player_name",
    "long_name": "player_full_name",
    "overall": "overall_rating",
    "potential": "potential_rating",
    "value_eur": "market_value_eur",
    "wage_eur": "weekly_wage_eur",
    "player_positions": "positions",
}
ALIASES = (
    Aliased("nationality", ("nationality", "nationality_name")),
    Aliased("club_name", ("club", "club_name")),
)
TRIMMED = ("player_name", "club_name", "league_name", "nationality")
UPPERED = ("preferred_foot",)
DEFAULTS = {
    "club_name": "Free Agent",
    "league_name": "Unknown",
    "market_value_eur": 0.0,
    "weekly_wage_eur": 0.0,
    "release_clause_eur": 0.0,
}
VALUE_TIER = Tier(
    "value_category", "market_value_eur", ">=",
    ((50_000_000, "World Class"), (20_000_000, "Elite"), (5_000_000, "Good"), (1_000_000, "Average")),
    "Budget",
)
AGE_TIER = Tier(
    "age_group", "age", "<",
    ((21, "U21 Prospect"), (25, "Young"), (30, "Prime"), (33, "Experienced")),
    "Veteran",
)
RATING_GAP = Gap("rating_gap", high="potential_rating", low="overall_rating")
RULES = (
    Rule("valid_player_id", "player_id IS NOT NULL"),
    Rule("valid_overall_rating", "overall_rating BETWEEN 1 AND 99"),
    Rule("valid_age", "age BETWEEN 15 AND 50"),
    Rule("valid_player_name", "player_name IS NOT NULL AND length(player_name) > 0"),
    Rule("valid_fifa_version", "fifa_version BETWEEN 15 AND 22"),
    Rule("non_negative_market_value", "market_value_eur >= 0", "warn"),
    Rule("non_negative_wage", "weekly_wage_eur >= 0", "warn"),
    Rule("non_negative_rating_gap", "rating_gap >= 0", "warn"),
)
KEYS = ("player_id", "fifa_version")
HISTORY_COLUMNS = (
    "player_id", "player_name", "nationality", "club_name", "league_name",
    "overall_rating", "market_value_eur", "fifa_version",
)
NATION_KEYS = ("nationality", "fifa_version")
NATION_MEASURES = (
    Measure("player_count", "count"),
    Measure("avg_rating", "avg", "overall_rating"),
    Measure("max_rating", "max", "overall_rating"),
)
CLUB_KEYS = ("club_name", "league_name", "fifa_version")
CLUB_MEASURES = (
    Measure("squad_size", "count", "player_id"),
    Measure("avg_squad_rating", "avg", "overall_rating", 1),
    Measure("total_squad_value", "sum", "market_value_eur", 0),
    Measure("total_weekly_wages", "sum", "weekly_wage_eur", 0),
    Measure("best_player_rating", "max", "overall_rating"),
    Measure("avg_squad_age", "avg", "age", 1),
    Measure("last_updated", "max", "processed_at"),
)
AGE_KEYS = ("age_group", "fifa_version")
AGE_MEASURES = (
    Measure("player_count", "count", "player_id"),
    Measure("avg_rating", "avg", "overall_rating", 1),
    Measure("avg_potential", "avg", "potential_rating", 1),
    Measure("avg_value", "avg", "market_value_eur", 0),
    Measure("avg_rating_gap", "avg", "rating_gap", 1),
    Measure("last_updated", "max", "processed_at"),
)
RAW = "players_raw"
SILVER = "players_silver"
RANKINGS = "player_rankings"
NATIONS = "nation_performance"
CLUBS = "club_analysis"
AGES = "age_analysis"
HISTORY = "transfer_history_scd2"
RULE_COUNTS = "players_rule_counts"
COMMENTS = {
    RAW: "Lines of all player files as they came",
    SILVER: "Cleaned and validated players, latest version per key",
    RANKINGS: "Every player and edition, with ratings, values and derived columns",
    NATIONS: "Players and ratings per nation and edition",
    CLUBS: "Squad size, ratings, value and wages per club and edition",
    AGES: "Ratings and values per age group and edition",
    HISTORY: "Clubs of each player with the period in which they held",
}
CLUSTER_BY = {
    SILVER: ("overall_rating", "market_value_eur"),
    RANKINGS: ("overall_rating", "fifa_version"),
    NATIONS: ("avg_rating", "fifa_version"),
    CLUBS: ("total_squad_value", "fifa_version"),
    AGES: ("avg_rating", "fifa_version"),
}
GOLD_PROPERTIES = {"quality": "gold"}
# End of fixed values.
# ---------------------------------------------------------------------------

ROWS_PER_FILE = 5_000_000
#: Which of two rows of one key and time stays.
TIES = (
    "ingested_at", "source_file", "player_name", "club_name", "league_name", "overall_rating",
    "potential_rating", "market_value_eur", "weekly_wage_eur", "age", "positions",
)

PROFILE = Profile(
    required=REQUIRED,
    casts=CASTS,
    renames=RENAMES,
    aliases=ALIASES,
    trimmed=TRIMMED,
    uppered=UPPERED,
    defaults=DEFAULTS,
    tiers=(VALUE_TIER, AGE_TIER),
    gaps=(RATING_GAP,),
    rules=RULES,
    keys=KEYS,
    version_column="silver_version",
)


def cleaned(raw: DataFrame, at: datetime | None = None) -> DataFrame:
    """Raw rows, batch or stream, through the cleaning chain."""
    return clean(raw, PROFILE, at=at)


def validated(rows: DataFrame, name: str = "players_rules") -> DataFrame:
    """Cleaned rows without those that fail a drop rule; all rules are counted."""
    return enforce(rows, PROFILE.rules, name)


def passing(rows: DataFrame) -> DataFrame:
    """The same rows without counters, so that filters of ad-hoc reads pass below."""
    return drop_failing(rows, PROFILE.rules)


def rankings(silver: DataFrame) -> DataFrame:
    """All cleaned rows."""
    return silver


def nation_performance(silver: DataFrame) -> DataFrame:
    return summarize(silver, NATION_KEYS, NATION_MEASURES)


def club_analysis(silver: DataFrame) -> DataFrame:
    return summarize(silver, CLUB_KEYS, CLUB_MEASURES)


def age_analysis(silver: DataFrame) -> DataFrame:
    return summarize(silver, AGE_KEYS, AGE_MEASURES)


def transfer_history(silver: DataFrame, closing: str = "appearance") -> DataFrame:
    """Clubs of each player with their periods; see ``change_history`` for ``closing``.

    The key allows one row per player and edition, so no player is too large for a task.
    """
    return change_history(
        silver, ["player_id"], EDITION, "club_name", closing, CENTURY,
        columns=HISTORY_COLUMNS, rows_per_piece=None,
    )


def top_players(ranked: DataFrame, edition: int, n: int = 10) -> DataFrame:
    return top_rows(
        ranked, n, "overall_rating", ("player_name", "player_id"),
        ("player_name", "nationality", "club_name", "overall_rating"), f"{EDITION} = {edition}",
    )


def top_nations(nations: DataFrame, edition: int, n: int = 10) -> DataFrame:
    return top_rows(
        nations, n, "player_count", ("nationality",),
        ("nationality", "player_count", "avg_rating", "max_rating"), f"{EDITION} = {edition}",
    )


def top_clubs(clubs: DataFrame, edition: int, n: int = 10) -> DataFrame:
    return top_rows(
        clubs, n, "total_squad_value", ("club_name", "league_name"),
        ("club_name", "total_squad_value"), f"{EDITION} = {edition}",
    )


def top_leagues(raw: DataFrame, edition: int, n: int = 10) -> DataFrame:
    return top_values(raw, "league_name", n, f"{EDITION} = {edition}")


@dataclass(frozen=True)
class PlayersLake:
    """The pipeline over one folder of CSV files, with its tables below ``root``."""

    source: str
    root: str
    bronze_layer: str = "bronze"
    silver_layer: str = "silver"
    gold_layer: str = "gold"
    new_columns: str = "add"
    buckets: int = 4

    @property
    def raw(self) -> RawTable:
        return RawTable(
            self.source, f"{self.root}/bronze/players_raw", number=EDITION, pattern=FILE_NAME,
            new_columns=self.new_columns,
        )

    @property
    def silver(self) -> KeyedTable:
        return KeyedTable(
            f"{self.silver_layer}.{SILVER}", f"{self.root}/silver/{SILVER}", KEYS, PROFILE.time_column, TIES,
            partition_by=EDITION, buckets=self.buckets, bucket_by=("player_id",),
        )

    def run(self, spark: SparkSession) -> list[int]:
        """Load new files and bring every table up to date; returns the changed editions."""
        self.ingest(spark)
        self.upsert(spark)
        return self.publish(spark)

    def ingest(self, spark: SparkSession) -> StreamingQuery:
        return self.raw.ingest(spark)

    def upsert(self, spark: SparkSession) -> StreamingQuery:
        """Clean, validate and merge what is new; what the rules count is added to a table."""
        self._ensure_layers(spark)
        keep_progress(spark)
        stream = validated(cleaned(self.raw.stream(spark)))
        query = upsert_available_now(stream, f"{self.silver.path}__checkpoint", self.silver)
        save_rule_counts(spark, query, "players_rules", f"{self.silver_layer}.{RULE_COUNTS}")
        return query

    def publish(self, spark: SparkSession) -> list[int]:
        """Bring the catalog tables up to date with the raw and the cleaned table.

        The batches merged since the last call name the partitions that they touched.  Rankings and
        summaries are recomputed for these editions; the history, which compares editions with each
        other, for the players of these buckets, over all editions.  Batches are forgotten when the call
        ends, so one that was cut short is made good by the next.  New columns reach every
        table.  Returns the editions that changed.
        """
        self._ensure_layers(spark)
        raw, silver = self.raw, self.silver
        register_partitioned(
            spark, f"{self.bronze_layer}.{RAW}", raw.path, raw.stored_schema(spark), LOAD,
            COMMENTS[RAW], {"quality": "bronze"},
        )
        batches, touched = silver.changed_partitions(spark)
        if not batches:
            return []
        editions = sorted({edition for edition, _ in touched})
        buckets = sorted({bucket for _, bucket in touched})
        silver.describe(spark, COMMENTS[SILVER], {"quality": "silver"})
        rows = silver.read_rows(spark)
        changed = rows.where(F.col(EDITION).isin(editions)).drop(BUCKET)
        history = transfer_history(rows.where(F.col(BUCKET).isin(buckets))).withColumn(BUCKET, silver.bucket())
        steps = [
            lambda: self._swap(spark, NATIONS, nation_performance(changed), EDITION),
            lambda: self._swap(spark, CLUBS, club_analysis(changed), EDITION),
            lambda: self._swap(spark, AGES, age_analysis(changed), EDITION),
            lambda: self._swap(spark, HISTORY, history, BUCKET, {}),
            lambda: self._publish_rankings(spark, rankings(changed)),
        ]
        # tables of their own, whose jobs share the cluster
        with ThreadPoolExecutor(max_workers=len(steps)) as pool:
            started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
            for step in started:
                step.result()
        silver.forget_changes(spark, batches)
        return editions

    def _ensure_layers(self, spark: SparkSession) -> None:
        layers = {"bronze": self.bronze_layer, "silver": self.silver_layer, "gold": self.gold_layer}
        for folder, layer in layers.items():
            ensure_layer(spark, layer, f"{self.root}/{folder}")

    def optimize(self, spark: SparkSession) -> None:
        """Cluster the five tables on the columns that filters use most."""
        self.publish(spark)
        self.silver.optimize(spark, CLUSTER_BY[SILVER])
        for table in (RANKINGS, NATIONS, CLUBS, AGES):
            name, path = self._gold(table), f"{self._folder(table)}/{uuid.uuid4().hex}"
            rows = spark.table(name)
            by = [c for c in CLUSTER_BY[table] if c != EDITION]
            count = rows.count()
            clustered = cluster(rows, by, max(1, ceil(count / ROWS_PER_FILE)), count, [EDITION])
            clustered.write.partitionBy(EDITION).parquet(path)
            point_partitions(spark, name, path, [EDITION])

    def _publish_rankings(self, spark: SparkSession, rows: DataFrame) -> None:
        # silver files hold one edition each
        self._swap(spark, RANKINGS, rows, EDITION, dealt=True)

    def _swap(
        self,
        spark: SparkSession,
        table: str,
        rows: DataFrame,
        column: str,
        properties: Mapping[str, str] = GOLD_PROPERTIES,
        dealt: bool = False,
    ) -> None:
        """Replace the partitions of a published table that occur in ``rows``."""
        name, folder = self._gold(table), self._folder(table)
        if not spark.catalog.tableExists(name):
            declare_table(spark, name, rows.schema, path=folder, partition_by=[column])
            set_properties(spark, name, COMMENTS[table], properties)
        grow_table(spark, name, rows.schema)
        swap_partitions(rows, name, folder, [column], dealt)

    def _gold(self, table: str) -> str:
        return f"{self.gold_layer}.{table}"

    def _folder(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def export(self, spark: SparkSession, folder: str) -> list[str]:
        """Copy the five tables to ``folder`` as external tables."""
        tables = [(self.silver_layer, SILVER)]
        tables += [(self.gold_layer, name) for name in (RANKINGS, NATIONS, CLUBS, AGES)]
        return export_external(
            spark, [(layer, name, f"{folder}/{layer}/{name}") for layer, name in tables]
        )

    def report(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Row counts after a load: raw rows, raw rows per edition, history rows."""
        raw = spark.table(f"{self.bronze_layer}.{RAW}")
        history = spark.table(self._gold(HISTORY))
        return {
            "raw_rows": row_count(raw),
            "raw_rows_per_edition": counts_by(raw, EDITION),
            "history_rows": row_count(history),
            "current_rows": row_count(history, "is_current = true"),
            "history_per_edition": load_report(history, EDITION, "is_current"),
        }

    def use(self, spark: SparkSession, layer: str | None = None) -> None:
        use_layer(spark, self.gold_layer if layer is None else layer)
