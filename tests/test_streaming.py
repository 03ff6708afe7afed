"""Streaming jobs: append, upsert, summaries, rule counters."""

import uuid

import pytest
from pyspark.sql import functions as F

from terrace.operators.quality import enforce
from terrace.operators.summary import summarize
from terrace.profile import Measure, Rule
from terrace.sinks.keyed import KeyedTable
from terrace.sinks.tables import save_table
from terrace.sources.tables import stream_named, stream_table
from terrace.streaming import jobs
from terrace.streaming.jobs import (
    append_available_now,
    keep_progress,
    save_rule_counts,
    summary_available_now,
    upsert_available_now,
    upsert_from_state,
)

SCHEMA = "id int, kind string, seq int"
MEASURES = [Measure("n", "count"), Measure("top", "max", "seq")]


@pytest.fixture()
def feed(spark, tmp_path):
    """A Parquet folder and a function that adds one file to it."""
    path = str(tmp_path / "feed")

    def add(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(path)

    add((1, "a", 1), (2, "b", 1))

    def stream(**settings):
        schema = spark.createDataFrame([], SCHEMA).schema
        return stream_table(spark, path, schema, **settings)

    return add, stream


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_twice(spark, feed, tmp_path):
    add, stream = feed
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for expected in (2, 2):
        append_available_now(stream(), checkpoint, path=out)
        assert spark.read.parquet(out).count() == expected
    add((3, "a", 1))
    append_available_now(stream(), checkpoint, path=out)
    assert spark.read.parquet(out).count() == 3


def test_append_to_a_table(spark, feed, tmp_path):
    _, stream = feed
    append_available_now(stream(), str(tmp_path / "cp"), table="appended")
    assert content(spark.table("appended")) == [(1, "a", 1), (2, "b", 1)]


def test_append_needs_one_target(feed, tmp_path):
    with pytest.raises(ValueError, match="either"):
        append_available_now(feed[1](), str(tmp_path / "cp"))


@pytest.mark.parametrize("job", [upsert_available_now, upsert_from_state])
def test_upsert_across_runs_and_batches(spark, feed, tmp_path, job):
    add, stream = feed
    name = f"upserted_{uuid.uuid4().hex}"
    keyed = KeyedTable(name, str(tmp_path / "t"), ("id", "kind"), "seq", partition_by="kind")
    checkpoint = str(tmp_path / "cp")
    job(stream(), checkpoint, keyed)
    add((1, "a", 3), (2, "b", 0))
    add((1, "a", 2), (4, "c", 1))
    job(stream(files_per_batch=1), checkpoint, keyed)
    expected = [(1, "a", 3), (2, "b", 1), (4, "c", 1)]
    assert content(keyed.read(spark).select("id", "kind", "seq")) == expected
    files = set(keyed.read(spark).inputFiles())
    job(stream(), checkpoint, keyed)
    assert content(keyed.read(spark).select("id", "kind", "seq")) == expected and set(keyed.read(spark).inputFiles()) == files


def test_complete_summary_replaces_the_table_after_each_batch(spark, feed, tmp_path, monkeypatch):
    add, stream = feed
    checkpoint, folder, name = str(tmp_path / "cp"), str(tmp_path / "out"), f"summary_{uuid.uuid4().hex}"

    def run(**settings):
        summary_available_now(summarize(stream(**settings), ["kind"], MEASURES), checkpoint, name, folder)
        return content(spark.table(name))

    assert run() == [("a", 1, 1), ("b", 1, 1)]
    add((5, "a", 9))
    add((6, "c", 2))
    seen, replace = [], jobs.replace_table

    def watched(frame, table, place):
        seen.append(content(spark.table(table)))
        return replace(frame, table, place)

    monkeypatch.setattr(jobs, "replace_table", watched)
    assert run(files_per_batch=1) == [("a", 2, 9), ("b", 1, 1), ("c", 1, 2)]
    # the table was whole before each of both batches
    assert [len(rows) for rows in seen] in ([2, 2], [2, 3])
    assert run() == [("a", 2, 9), ("b", 1, 1), ("c", 1, 2)]


def test_table_to_table_by_name(spark, feed, tmp_path):
    source, copy = (f"{n}_{uuid.uuid4().hex}" for n in ("source", "copy"))
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    for expected in (2, 4):
        save_table(rows, source, mode="append")
        append_available_now(stream_named(spark, source, 1), str(tmp_path / "cp"), table=copy)
        assert spark.table(copy).count() == expected
    append_available_now(stream_named(spark, source), str(tmp_path / "cp"), table=copy)
    assert spark.table(copy).count() == 4


def test_rule_counters_are_kept_per_batch(spark, feed, tmp_path):
    add, stream = feed
    rules = [Rule("kind_a", "kind = 'a'"), Rule("positive", "seq > 5", "warn")]
    name = f"counts_{uuid.uuid4().hex}"
    add((3, "a", 9))
    keep_progress(spark)
    for _ in range(2):
        query = append_available_now(
            enforce(stream(files_per_batch=1), rules, "checks"), str(tmp_path / "cp"), path=str(tmp_path / "out")
        )
        save_rule_counts(spark, query, "checks", name)
    found = spark.table(name).groupBy("rule").agg(F.sum("violations"), F.count_distinct("batch_id"))
    sums = {r[0]: r[1] for r in found.collect()}
    assert sums == {"rows": 3, "kind_a": 1, "positive": 2}
    assert {r[2] for r in found.collect()} == {spark.table(name).select("batch_id").distinct().count()}


def test_rule_counters_arrive_in_the_progress(feed, tmp_path):
    _, stream = feed
    rules = [Rule("kind_a", "kind = 'a'"), Rule("positive", "seq > 5", "warn")]
    query = append_available_now(
        enforce(stream(), rules, "checks"), str(tmp_path / "cp"), path=str(tmp_path / "out")
    )
    seen = query.lastProgress["observedMetrics"]["checks"].asDict()
    assert seen == {"rows": 2, "kind_a": 1, "positive": 2}
