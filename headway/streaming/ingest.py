"""Continuous and one-shot ingest into the raw table."""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.ingest import outcomes
from headway.sources.batches import commit_batch, ledger, totals
from headway.sources.raw import PARTITION

POLL_INTERVAL = "30 seconds"  # fixed value
ONCE = "once"
METRIC = "ingest"


def trigger_options(trigger: str) -> dict:
    """``"once"`` drains what is there and stops; anything else is a processing-time interval."""
    return {"availableNow": True} if trigger == ONCE else {"processingTime": trigger}


def start_ingest(
    arrivals: DataFrame, path: str, checkpoint: str, trigger: str = POLL_INTERVAL
) -> StreamingQuery:
    """Append a streaming frame of arrivals to the day-partitioned raw table.

    The parquet sink commits each micro-batch once, so a restart from ``checkpoint`` adds no copies.
    ``checkpoint`` and ``path`` must be in shared storage on a cluster.
    """
    observed = arrivals.observe(METRIC, F.count(F.lit(1)).alias("inserted"))
    return (
        observed.writeStream.format("parquet")
        .partitionBy(PARTITION)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger_options(trigger))
        .start()
    )


def start_rejects(
    rejects: DataFrame, path: str, checkpoint: str, trigger: str = POLL_INTERVAL
) -> StreamingQuery:
    """Append a streaming frame of rejected documents to parquet files, with the day they were fetched.

    A stream of its own with its own ``checkpoint``: documents are parsed once more, but both sinks commit
    each micro-batch exactly once, and a failure of one leaves the other alone.
    """
    observed = rejects.withColumn("fetched_date", F.to_date("fetched_at")).observe(
        METRIC, F.count(F.lit(1)).alias("inserted")
    )
    return (
        observed.writeStream.format("parquet")
        .partitionBy("fetched_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger_options(trigger))
        .start()
    )


def start_outcomes(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = POLL_INTERVAL,
    network_pairs: DataFrame | None = None,
    lines: Iterable[str] | None = None,
    random_ids: bool = False,
) -> StreamingQuery:
    """Parse a streaming frame of documents once, and keep accepted rows and rejects in one table.

    Both outcomes of a micro-batch are one job and one entry in the table's ledger (``headway.sources.batches``),
    so they are there together and once, also over crashes and restarts from ``checkpoint``. Files are as many
    as a day's rows need, not one a task and day. Several streams may write to one table: batches are told
    apart by the id that the checkpoint gives a stream, which a new checkpoint never shares.
    """
    lines = None if lines is None else list(lines)
    started, query = threading.Event(), None

    def keep(batch: DataFrame, number: int) -> None:
        if not started.wait(300):
            raise RuntimeError("the stream gave no id")
        rows = outcomes(batch, network_pairs, lines, random_ids)
        commit_batch(batch.sparkSession, path, query.id, number, query.runId, rows)

    writer = envelopes.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    query = writer.trigger(**trigger_options(trigger)).start()
    started.set()
    return query


def cause_of(query: StreamingQuery) -> str | None:
    """Why a query failed: the innermost cause, or the last line of the message; None if it did not fail."""
    error = query.exception()
    if error is None:
        return None
    told = str(error).split("=== Streaming Query ===")[0]  # the plan follows
    lines = [line for line in map(str.strip, told.splitlines()) if line and not line.startswith("at ")]
    causes = [line for line in lines if line.startswith("Caused by:")]
    return (causes or lines or [type(error).__name__])[-1]


def outcome_summary(spark: SparkSession, query: StreamingQuery, path: str) -> dict:
    """What a run of ``start_outcomes`` did, and the totals of all runs, from the ledger.

    Counts are of this run's micro-batches, however many; the totals hold over restarts. ``error`` says why a
    run failed.
    """
    entries = [e for e in ledger(spark, path) if e.run == query.runId]
    every = totals(spark, path)
    error = cause_of(query)
    summary = {
        "status": "failed" if error else "success",
        "inserted": sum(e.inserted for e in entries),
        "rejected": sum(e.rejected for e in entries),
        "total_inserted": every["inserted"],
        "total_rejected": every["rejected"],
    }
    return {**summary, "error": error} if error else summary


def follow_outcomes(spark: SparkSession, query: StreamingQuery, path: str) -> dict:
    """Wait for the end of the query and give its summary; a failure is in the status, its cause in ``error``."""
    try:
        query.awaitTermination()
    except StreamingQueryException:
        pass  # the summary has it
    return outcome_summary(spark, query, path)


def ingest_summary(query: StreamingQuery, per_batch: dict[int, int] | None = None) -> dict:
    """``{"status", "inserted"}`` of the run, from the row count observed in each micro-batch; ``error`` if it failed.

    Spark keeps the last 100 reports (``spark.sql.streaming.numRecentProgressUpdates``). ``per_batch``
    holds the counts of earlier ones and is brought up to date; ``follow_ingest`` does so while it waits.
    """
    per_batch = {} if per_batch is None else per_batch
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(METRIC)
        if row is not None:
            per_batch[progress.batchId] = row["inserted"]
    error = cause_of(query)
    summary = {"status": "failed" if error else "success", "inserted": sum(per_batch.values())}
    return {**summary, "error": error} if error else summary


def follow_ingest(query: StreamingQuery, seconds: int = 1) -> dict:
    """Wait for the end of the query and give its summary, however many micro-batches it ran.

    Reports are read every few ``seconds``, long before Spark drops them. A failure is in the status, its cause in ``error``.
    """
    per_batch: dict[int, int] = {}
    try:
        while not query.awaitTermination(seconds):
            ingest_summary(query, per_batch)
    except StreamingQueryException:
        pass  # the summary has it
    return ingest_summary(query, per_batch)
