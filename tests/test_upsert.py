"""Latest-wins reduction and the keyed table, also when a run stops half-way."""

import re
import uuid
from datetime import datetime
from itertools import permutations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from terrace.operators.upsert import latest_by_key, upsert
from terrace.sinks import keyed as keyed_module
from terrace.sinks import tables
from terrace.sinks.keyed import KeyedTable

SCHEMA = "id int, edition int, name string, seq int, tie int"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(df):
    order = [c for c in ("id", "edition", "name", "seq", "tie", "extra") if c in df.columns]
    return sorted(tuple(r) for r in df.select(*order).collect())


def keyed_at(tmp_path, keys, ties=(), **settings):
    return KeyedTable(f"keyed_{uuid.uuid4().hex}", str(tmp_path / "t"), keys, "seq", ties, **settings)


@pytest.fixture()
def keyed(tmp_path):
    return keyed_at(tmp_path, ("id", "edition"), ("tie",), partition_by="edition")


def test_greatest_sequence_wins(spark):
    rows = batch(spark, (1, 15, "old", 1, 0), (1, 15, "new", 2, 0), (2, 15, "only", 1, 0))
    found = content(latest_by_key(rows, ["id", "edition"], "seq"))
    assert found == [(1, 15, "new", 2, 0), (2, 15, "only", 1, 0)]


def test_ties_and_null_sequences(spark):
    rows = batch(spark, (1, 15, "a", 1, 0), (1, 15, "b", 1, 1), (1, 15, "n", None, 9), (2, 15, "n", None, 0))
    found = content(latest_by_key(rows, ["id", "edition"], "seq", ["tie"]))
    assert [r[2] for r in found] == ["b", "n"]


def test_null_keys_are_one_key(spark):
    rows = batch(spark, (None, 15, "a", 1, 0), (None, 15, "b", 2, 0))
    assert [r[2] for r in content(latest_by_key(rows, ["id", "edition"], "seq"))] == ["b"]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_by_key(rows, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_batches_in_any_order_and_repeated(spark):
    batches = [
        batch(spark, (1, 15, "a", 1, 0), (2, 15, "x", 5, 0)),
        batch(spark, (1, 15, "b", 3, 0), (2, 15, "y", 4, 0)),
        batch(spark, (1, 15, "c", 2, 0), (3, 16, "z", 1, 0)),
    ]
    expected = [(1, 15, "b", 3, 0), (2, 15, "x", 5, 0), (3, 16, "z", 1, 0)]
    for order in permutations(batches):
        current = order[0]
        for changes in (*order[1:], order[0]):
            current = upsert(current, changes, ["id", "edition"], "seq", ["tie"])
        assert content(current) == expected


def test_keyed_table_inserts_updates_and_ignores_older(spark, keyed):
    keyed.merge(batch(spark, (1, 15, "a", 2, 0), (2, 16, "b", 1, 0)))
    keyed.merge(batch(spark, (1, 15, "older", 1, 0), (2, 16, "newer", 2, 0), (3, 17, "c", 1, 0)))
    assert content(keyed.read(spark)) == [
        (1, 15, "a", 2, 0), (2, 16, "newer", 2, 0), (3, 17, "c", 1, 0),
    ]


def test_keyed_table_replay_changes_nothing(spark, keyed):
    changes = batch(spark, (1, 15, "a", 2, 0), (2, 16, "b", 1, 0))
    keyed.merge(changes)
    before = content(keyed.read(spark))
    keyed.merge(changes)
    keyed.merge(batch(spark))
    assert content(keyed.read(spark)) == before


def test_only_touched_partitions_are_rewritten(spark, keyed):
    keyed.merge(batch(spark, (1, 15, "a", 1, 0), (2, 16, "b", 1, 0)))
    before = set(keyed.read(spark).inputFiles())
    keyed.merge(batch(spark, (2, 16, "c", 2, 0)))
    after = set(keyed.read(spark).inputFiles())
    assert {f for f in before & after} == {f for f in before if "edition=15" in f}


def test_keyed_table_with_null_partition(spark, keyed):
    keyed.merge(batch(spark, (1, None, "a", 1, 0)))
    keyed.merge(batch(spark, (1, None, "b", 2, 0), (1, 15, "c", 1, 0)))
    assert [r["name"] for r in keyed.read(spark).orderBy("name").collect()] == ["b", "c"]


def test_partition_text_keeps_its_type(spark, tmp_path):
    keyed = keyed_at(tmp_path, ("id", "zone"), partition_by="zone")
    rows = spark.createDataFrame([(1, "007", 1), (2, "7", 1)], "id int, zone string, seq int")
    keyed.merge(rows)
    keyed.merge(rows)
    assert sorted(r["zone"] for r in keyed.read(spark).collect()) == ["007", "7"]


def test_new_columns_keep_old_rows(spark, keyed):
    keyed.merge(batch(spark, (1, 15, "a", 1, 0), (2, 15, "b", 1, 0)))
    keyed.merge(batch(spark, (1, 15, "c", 2, 0)).withColumn("extra", F.lit("e")))
    found = {r["id"]: r["extra"] for r in keyed.read(spark).collect()}
    assert found == {1: "e", 2: None}
    keyed.merge(batch(spark, (2, 15, "d", 3, 0)))
    assert {r["id"]: r["extra"] for r in keyed.read(spark).collect()} == {1: "e", 2: None}


def test_unpartitioned_keyed_table(spark, tmp_path):
    keyed = keyed_at(tmp_path, ("id",))
    keyed.merge(batch(spark, (1, 15, "a", 1, 0), (2, 15, "b", 1, 0)))
    keyed.merge(batch(spark, (1, 15, "c", 2, 0)))
    assert [r[2] for r in content(keyed.read(spark))] == ["c", "b"]


@pytest.mark.parametrize("step", ["swap_partitions", "upsert"])
def test_killed_merge_leaves_the_old_rows(spark, keyed, monkeypatch, step):
    keyed.merge(batch(spark, (1, 15, "a", 1, 0), (2, 15, "b", 1, 0), (3, 16, "c", 1, 0)))

    class Stopped(Exception):
        pass

    def stop(*_, **__):
        raise Stopped

    with monkeypatch.context() as patched:
        patched.setattr(keyed_module, step, stop)
        with pytest.raises(Stopped):
            keyed.merge(batch(spark, (1, 15, "new", 2, 0)))
    assert [r[2] for r in content(keyed.read(spark))] == ["a", "b", "c"]
    keyed.merge(batch(spark, (1, 15, "new", 2, 0), (3, 16, "d", 2, 0)))
    assert [r[2] for r in content(keyed.read(spark))] == ["new", "b", "d"]


def test_merge_that_stopped_among_partitions_is_completed_by_its_replay(spark, keyed, monkeypatch):
    keyed.merge(batch(spark, (1, 15, "a", 1, 0), (1, 16, "b", 1, 0)))
    changes = batch(spark, (1, 15, "c", 2, 0), (1, 16, "d", 2, 0))
    pointed = tables.folders

    with monkeypatch.context() as patched:
        patched.setattr(tables, "folders", lambda *a: pointed(*a)[:1])
        keyed.merge(changes)
    assert [r[2] for r in content(keyed.read(spark))] == ["c", "b"]
    keyed.merge(changes)
    assert [r[2] for r in content(keyed.read(spark))] == ["c", "d"]


def test_files_of_earlier_readers_stay(spark, keyed):
    keyed.merge(batch(spark, (1, 15, "a", 1, 0)))
    files = keyed.read(spark).inputFiles()
    keyed.merge(batch(spark, (1, 15, "b", 2, 0)))
    assert all(Path(f.removeprefix("file://")).exists() for f in files)
    assert keyed.read(spark).inputFiles() != files


def test_a_merge_of_one_key_reads_and_writes_one_partition(spark, tmp_path, monkeypatch):
    keyed = keyed_at(tmp_path, ("id",), buckets=16)
    keyed.merge(batch(spark, *[(n, 15, "a", 1, 0) for n in range(200)]))
    before, read = set(keyed.read(spark).inputFiles()), []

    def watched(current, *rest):
        read.extend(current.inputFiles())
        plan = current._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*key_bucket", plan)
        read.append(current.select("key_bucket").distinct().count())
        return upsert(current, *rest)

    monkeypatch.setattr(keyed_module, "upsert", watched)
    assert len(keyed.merge(batch(spark, (7, 15, "b", 2, 0)))) == 1
    assert read[-1] == 1
    after = set(keyed.read(spark).inputFiles())
    assert len(before - after) == 1 and len(after - before) == 1
    assert keyed.read(spark).count() == 200 and keyed.read(spark).where("name = 'b'").count() == 1


def test_rows_of_new_partitions_are_written_once(spark, keyed, monkeypatch):
    """Only what shares a partition with rows of the table is merged with them."""
    merged = []

    def watched(current, incoming, *rest):
        merged.append((content(current), content(incoming)))
        return upsert(current, incoming, *rest)

    monkeypatch.setattr(keyed_module, "upsert", watched)
    keyed.merge(batch(spark, (1, 15, "old", 1, 0), (1, 15, "a", 2, 0), (1, 15, "older", 0, 9)))
    keyed.merge(batch(spark, (2, 16, "b", 1, 0), (2, 16, "c", 1, 1), (3, None, "n", 1, 0)))
    assert merged == []
    found = keyed.merge(batch(spark, (1, 15, "d", 3, 0), (4, 17, "e", 2, 0), (4, 17, "f", 1, 0)))
    assert merged == [([(1, 15, "a", 2, 0)], [(1, 15, "d", 3, 0)])]
    assert sorted(edition for edition, _ in found) == [15, 17]
    assert {r["name"] for r in keyed.read(spark).collect()} == {"c", "d", "e", "n"}
    assert len(keyed.changed_partitions(spark)[0]) == 3


def test_view_follows_merges_and_new_columns(spark, keyed):
    keyed.merge(batch(spark, (1, 15, "a", 1, 0), (2, None, "n", 1, 0)))
    keyed.describe(spark, "a comment", {"quality": "silver"})
    keyed.merge(batch(spark, (1, 15, "b", 2, 0)).withColumn("extra", F.lit("e")))
    found = spark.table(keyed.name)
    assert sorted(found.columns) == sorted(["id", "edition", "name", "seq", "tie", "extra"])
    assert sorted((r["name"], r["extra"]) for r in found.collect()) == [("b", "e"), ("n", None)]
    shown = {r["key"]: r["value"] for r in tables.table_properties(spark, keyed.rows_name).collect()}
    assert shown["quality"] == "silver"


def test_changes_are_named_until_they_are_forgotten(spark, keyed):
    assert keyed.changed_partitions(spark) == ([], [])
    for edition in (15, 16):
        keyed.merge(batch(spark, (1, edition, "a", 1, 0)))
    batches, touched = keyed.changed_partitions(spark)
    assert len(batches) == 2 and sorted(t[0] for t in touched) == [15, 16]
    keyed.forget_changes(spark, batches[:1])
    assert keyed.changed_partitions(spark)[0] == batches[1:]


def test_buckets_of_some_keys(spark, tmp_path):
    keyed = keyed_at(tmp_path, ("id", "edition"), partition_by="edition", bucket_by=("id",))
    keyed.merge(batch(spark, *[(n, e, "a", 1, 0) for n in range(20) for e in (15, 16)]))
    rows = keyed.read_rows(spark).groupBy("id").agg(F.count_distinct("key_bucket").alias("n"))
    assert rows.where("n > 1").isEmpty()
    with pytest.raises(ValueError, match="keys"):
        keyed_at(tmp_path, ("id",), bucket_by=("name",))


def test_optimize_keeps_every_row_and_covers_small_boxes(spark, tmp_path):
    keyed = keyed_at(tmp_path, ("id", "edition"), ("tie",), partition_by="edition", buckets=4)
    rows = spark.range(4000).select(
        (F.col("id") % 1000).cast("int").alias("id"), (F.col("id") % 4).cast("int").alias("edition"),
        F.lit("n").alias("name"), F.lit(1).alias("seq"),
        (F.xxhash64("id") % 1000).cast("int").alias("tie"),
    ).dropDuplicates(["id", "edition"])
    keyed.merge(rows)
    keyed.optimize(spark, ["tie"], rows_per_file=25)
    found = keyed.read(spark)
    assert content(found) == content(rows)
    spans = keyed.read(spark).groupBy(F.input_file_name()).agg((F.max("tie") - F.min("tie")).alias("span"))
    assert spans.agg(F.avg("span")).first()[0] < 0.5 * 2000


def test_partition_column_must_be_a_key():
    with pytest.raises(ValueError, match="key"):
        KeyedTable("t", "t", ("id",), "seq", partition_by="edition")


def test_timestamps_order_a_sequence(spark):
    rows = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 2))], "id int, at timestamp"
    )
    assert latest_by_key(rows, ["id"], "at").first()["at"] == datetime(2024, 1, 2)
