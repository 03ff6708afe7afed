"""Streaming jobs that run until the input is exhausted and then stop.

Progress lives in the checkpoint folder: a second run over the same input adds
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from terrace.sinks.keyed import KeyedTable
from terrace.sinks.tables import replace_table

#: Batches of one run whose counters are kept.
PROGRESS = 100_000
_COUNTS = "run_id string, batch_id long, rule string, violations long"


def append_available_now(
    stream: DataFrame, checkpoint: str, path: str | None = None, table: str | None = None
) -> StreamingQuery:
    """Append to a Parquet folder or table, exactly once."""
    if (path is None) == (table is None):
        raise ValueError("give either path or table")
    writer = _available_now(stream, checkpoint).format("parquet").outputMode("append")
    query = writer.start(path) if table is None else writer.toTable(table)
    query.awaitTermination()
    return query


def upsert_available_now(stream: DataFrame, checkpoint: str, target: KeyedTable) -> StreamingQuery:
    """Merge each micro-batch into a keyed table; replayed batches change nothing.

    Nothing is held between batches, and columns may be added from run to run.
    """
    writer = _available_now(stream, checkpoint)
    query = writer.foreachBatch(lambda batch, _: target.merge(batch) and None).start()
    query.awaitTermination()
    return query


def upsert_from_state(stream: DataFrame, checkpoint: str, target: KeyedTable) -> StreamingQuery:
    """Merge the latest row of each key that a micro-batch brought, as Spark's state has it.

    The state keeps one row per key, so an older row that comes late, in whatever batch, loses to it before the
    table is touched.  The columns of the stream are part of the state: they are fixed
    with the checkpoint.
    """
    order = F.struct(target.sequence, *(t for t in target.ties if t in stream.columns))
    newest = F.max_by(F.struct(*stream.columns), order).alias("newest")
    kept = stream.groupBy(*target.keys).agg(newest).select("newest.*")
    writer = _available_now(kept, checkpoint).outputMode("update")
    query = writer.foreachBatch(lambda batch, _: target.merge(batch) and None).start()
    query.awaitTermination()
    return query


def summary_available_now(
    summary: DataFrame, checkpoint: str, name: str, folder: str
) -> StreamingQuery:
    """Keep a grouped summary of an append-only stream as the table ``name``.

    The groups are Spark's streaming state.  After each micro-batch the complete result is written to a
    new folder below ``folder`` and the table pointed there, so the one before stays readable until
    then and a replayed batch replaces itself.  Over a table whose rows change, recompute
    the summary from the table instead: a stream would count a changed row twice.
    """

    def replace(complete: DataFrame, _: int) -> None:
        replace_table(complete, name, folder)

    writer = _available_now(summary, checkpoint).outputMode("complete")
    query = writer.foreachBatch(replace).start()
    query.awaitTermination()
    # batches run in a session of their own; this one may remember the files before
    if summary.sparkSession.catalog.tableExists(name):
        summary.sparkSession.catalog.refreshTable(name)
    return query


def keep_progress(spark: SparkSession) -> None:
    """Let queries that start from now on remember enough batches for ``save_rule_counts``."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", PROGRESS)


def save_rule_counts(spark: SparkSession, query: StreamingQuery, rules: str, table: str) -> None:
    """Add what a finished query counted for ``rules`` (the name given to ``enforce``) to a table.

    One row for each micro-batch and rule, and one per batch named ``rows``.  Counters come from the
    query's progress; a batch that failed has none, its replay has.
    """
    found = []
    for progress in query.recentProgress:
        counters = progress["observedMetrics"].get(rules)
        if counters is not None:
            batch = progress["runId"], progress["batchId"]
            found += [(str(batch[0]), batch[1], *c) for c in sorted(counters.asDict().items())]
    if found:
        lines = spark.createDataFrame(found, _COUNTS).coalesce(1)
        lines.write.format("parquet").mode("append").saveAsTable(table)


def _available_now(stream: DataFrame, checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
