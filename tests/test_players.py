"""The whole pipeline from CSV files to published tables, over several deliveries."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from terrace.plans import players
from terrace.plans.players import PlayersLake

EARLY = (
    "sofifa_id,short_name,long_name,age,height_cm,weight_kg,nationality,club,league_name,overall,"
    "potential,value_eur,wage_eur,player_positions,preferred_foot,international_reputation,"
    "release_clause_eur,dob\n"
)
LATE = EARLY.replace("nationality,club,", "nationality_name,club_name,").replace("dob", "extra")


def line(player, club, age=25, overall=80, value="6000000"):
    return (
        f'{player}, Name {player} ,Long,{age},180,75,Norland,{club},,{overall},85,{value},100,'
        f'"RW, ST", left,1,,x\n'
    )


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("players")
    (root / "in").mkdir()
    lake = PlayersLake(str(root / "in"), str(root / "lake"))

    def deliver(edition, header, *lines):
        (root / "in" / f"players_{edition}.csv").write_text(header + "".join(lines))
        return lake.run(spark)

    deliver(15, EARLY, line(1, "A"), line(2, ""), line("", "A"), line(9, "A", age=60))
    deliver(16, LATE, line(1, "A"), line(2, "B", value="unknown"))
    assert deliver(17, LATE, line(1, "B")) == [17]
    assert lake.run(spark) == []
    return lake


def test_both_spellings_arrive(spark, lake):
    silver = spark.table(f"silver.{players.SILVER}")
    found = {(r["player_id"], r["fifa_version"]): r for r in silver.collect()}
    assert set(found) == {(1, 15), (1, 16), (1, 17), (2, 15), (2, 16)}
    assert [found[k]["club_name"] for k in sorted(found)] == ["A", "A", "B", "Free Agent", "B"]
    assert {r["nationality"] for r in found.values()} == {"Norland"}
    assert found[2, 16]["value_category"] == "Budget" and found[1, 15]["value_category"] == "Good"


def test_raw_keeps_every_row_and_column(spark, lake):
    raw = lake.raw.read(spark)
    assert raw.count() == 7 and {"dob", "extra", "club", "club_name"} <= set(raw.columns)


def test_published_tables(spark, lake):
    assert spark.table(f"gold.{players.RANKINGS}").count() == 5
    nations = spark.table(f"gold.{players.NATIONS}").collect()
    assert sorted((r["fifa_version"], r["player_count"]) for r in nations) == [(15, 2), (16, 2), (17, 1)]
    clubs = spark.table(f"gold.{players.CLUBS}")
    assert clubs.columns == [
        "club_name", "league_name", "squad_size", "avg_squad_rating", "total_squad_value",
        "total_weekly_wages", "best_player_rating", "avg_squad_age", "last_updated", "fifa_version",
    ]
    assert clubs.count() == 5
    assert spark.table(f"gold.{players.AGES}").count() == 3


def test_summaries_equal_a_full_recomputation(spark, lake):
    silver = lake.silver.read(spark)
    for name, build in (
        (players.NATIONS, players.nation_performance),
        (players.CLUBS, players.club_analysis),
        (players.AGES, players.age_analysis),
    ):
        published = spark.table(f"gold.{name}")
        full = build(silver).select(published.columns)
        assert full.exceptAll(published).isEmpty() and published.exceptAll(full).isEmpty()


def test_history(spark, lake):
    found = spark.table(f"gold.{players.HISTORY}").orderBy("player_id", "start_year").collect()
    assert [(r["player_id"], r["club_name"], r["start_year"], r["end_year"], r["is_current"]) for r in found] == [
        (1, "A", 2015, 2016, False), (1, "B", 2017, None, True),
        (2, "Free Agent", 2015, 2016, False), (2, "B", 2016, None, True),
    ]


def test_one_changed_player_rewrites_one_bucket_of_the_history(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lake = PlayersLake(str(tmp_path / "in"), str(tmp_path / "lake"), "hist_b", "hist_s", "hist_g", buckets=8)

    def deliver(edition, header, *lines):
        (tmp_path / "in" / f"players_{edition}.csv").write_text(header + "".join(lines))
        lake.run(spark)
        table = spark.table(f"hist_g.{players.HISTORY}")
        full = players.transfer_history(lake.silver.read(spark)).select(*[c for c in table.columns if c != "key_bucket"])
        found = table.drop("key_bucket")
        assert full.exceptAll(found).isEmpty() and found.exceptAll(full).isEmpty()
        return {f for f in table.inputFiles()}

    before = deliver(15, EARLY, *(line(n, "AB"[n % 2]) for n in range(1, 40)))
    after = deliver(16, LATE, line(7, "C"))
    assert len(before) == 8 and len(before - after) == 1 and len(after - before) == 1


def test_rankings_are_copied_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Rows come by edition already, so each file of the cleaned table is read and written once."""
    (tmp_path / "in").mkdir()
    lake = PlayersLake(str(tmp_path / "in"), str(tmp_path / "lake"), "copy_b", "copy_s", "copy_g")
    for edition in (15, 16):
        lines = "".join(line(n, "A") for n in range(1, 30))
        (tmp_path / "in" / f"players_{edition}.csv").write_text(EARLY + lines)
    lake.ingest(spark)
    lake.upsert(spark)
    hinted, frames = [], type(spark.range(1))
    plain = frames.hint
    monkeypatch.setattr(frames, "hint", lambda df, *a: hinted.append(set(df.columns)) or plain(df, *a))
    lake.publish(spark)
    silver, ranked = lake.silver.read(spark), spark.table(f"copy_g.{players.RANKINGS}")
    assert len(hinted) == 4 and set(ranked.columns) not in hinted
    assert silver.exceptAll(ranked.select(silver.columns)).isEmpty() and ranked.count() == 58
    assert len(ranked.inputFiles()) <= len(silver.inputFiles())


def test_rule_counts_are_kept(spark, lake):
    counts = spark.table(f"silver.{players.RULE_COUNTS}").groupBy("rule").sum("violations").collect()
    counts = dict(map(tuple, counts))
    assert counts["rows"] >= 7 and counts["valid_player_id"] == 1 and counts["valid_age"] == 1


def test_exploration(spark, lake):
    ranked = spark.table(f"gold.{players.RANKINGS}")
    top = players.top_players(ranked, 16).collect()
    assert [r["player_name"] for r in top] == ["Name 1", "Name 2"]
    assert players.top_nations(spark.table(f"gold.{players.NATIONS}"), 16).first()["player_count"] == 2
    assert players.top_clubs(spark.table(f"gold.{players.CLUBS}"), 16).first()["club_name"] == "A"
    assert players.top_leagues(lake.raw.read(spark), 15).first().asDict() == {"league_name": None, "count": 4}


def test_report(spark, lake):
    report = {k: [tuple(r) for r in v.collect()] for k, v in lake.report(spark).items()}
    assert report["raw_rows"] == [(7,)]
    assert report["raw_rows_per_edition"] == [(15, 4), (16, 2), (17, 1)]
    assert report["history_rows"] == [(4,)] and report["current_rows"] == [(2,)]


def test_raw_table_and_layers(spark, lake):
    assert spark.table(f"bronze.{players.RAW}").count() == 7
    for layer in ("bronze", "silver", "gold"):
        assert spark.catalog.getDatabase(layer).locationUri.endswith(f"{lake.root}/{layer}")


def test_new_columns_reach_every_table_and_late_rows_are_published(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lake = PlayersLake(str(tmp_path / "in"), str(tmp_path / "lake"), "grown_b", "grown_s", "grown_g")
    lacking = ("height_cm,", "weight_kg,", "international_reputation,")
    header = EARLY
    for name in lacking:
        header = header.replace(name, "")
    short = '7,Name 7,Long,25,Norland,A,,80,85,6000000,100,"RW, ST",left,,x\n'
    (tmp_path / "in" / "players_15.csv").write_text(header + short)
    assert lake.run(spark) == [15]
    tables = (f"grown_s.{players.SILVER}", f"grown_g.{players.RANKINGS}")
    assert {len(spark.table(t).columns) for t in tables} == {22}
    (tmp_path / "in" / "players_16.csv").write_text(EARLY + line(7, "B"))
    assert lake.run(spark) == [16]
    for t in tables:
        assert len(spark.table(t).columns) == 25
        assert {r["fifa_version"]: r["height_cm"] for r in spark.table(t).collect()} == {15: None, 16: 180}
    # a new player with an earlier time than all that is there
    late = lake.silver.read(spark).where("fifa_version = 16").withColumns(
        {"player_id": F.lit(8), "processed_at": F.lit("2001-01-01").cast("timestamp")}
    )
    lake.silver.merge(late)
    assert lake.publish(spark) == [16] and lake.publish(spark) == []
    assert spark.table(tables[1]).count() == 3
    nations = spark.table(f"grown_g.{players.NATIONS}").where("fifa_version = 16")
    assert nations.first()["player_count"] == 2


def test_equal_times_have_one_winner(spark, tmp_path):
    found = set()
    for n, order in enumerate(((1, 2), (2, 1))):
        (tmp_path / f"in{n}").mkdir()
        lake = PlayersLake(str(tmp_path / f"in{n}"), str(tmp_path / f"lake{n}"))
        lines = {1: line(5, "A"), 2: line(5, "B")}
        (tmp_path / f"in{n}" / "players_15.csv").write_text(EARLY + "".join(lines[i] for i in order))
        lake.ingest(spark)
        lake.upsert(spark)
        found.add(lake.silver.read(spark).first()["club_name"])
    assert found == {"B"}


def test_interrupted_publish_is_made_good(spark, lake, monkeypatch):
    class Stopped(Exception):
        pass

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as patched:
        patched.setattr(PlayersLake, "_publish_rankings", stop)
        Path(lake.source, "players_18.csv").write_text(LATE + line(3, "C"))
        with pytest.raises(Stopped):
            lake.run(spark)
    assert lake.publish(spark) == [18]
    assert spark.table(f"gold.{players.NATIONS}").where("fifa_version = 18").count() == 1
    assert spark.table(f"gold.{players.RANKINGS}").count() == 6


def test_optimize_and_export(spark, lake, tmp_path):
    before = {t: spark.table(t).count() for t in ("silver.players_silver", "gold.player_rankings", "gold.club_analysis")}
    lake.optimize(spark)
    for table, rows in before.items():
        assert spark.table(table).count() == rows
    names = lake.export(spark, str(tmp_path / "out"))
    assert len(names) == 5
    assert spark.table("gold.player_rankings_external").count() == before["gold.player_rankings"]
    assert lake.run(spark) == []
    lake.use(spark)
    assert spark.catalog.currentDatabase() == "gold"
    lake.use(spark, "default")
