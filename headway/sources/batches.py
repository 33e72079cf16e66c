"""The raw table as a stream leaves it: a folder for each micro-batch, a ledger, and compacted days.

    batches/stream=S/batch=N/outcome=O/ingestion_date=D/   what became of a micro-batch's documents
    ledger/stream=S/batch=N/                               one row: that batch counts, and what it holds
    days/version=V/outcome=O/ingestion_date=D/             rows of many batches, clustered, in few files
    manifest/version=V/                                    one row: the days that count, the batches they hold

``outcome`` is ``accepted`` or ``rejected``. Only what the ledger or the newest manifest names counts, so files
of a batch or compaction that failed are never read and are written over when it is tried again. Everything
lies in shared storage, and is read and written as ordinary parquet and JSON.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.ingest import as_rejects
from headway.schemas import OUTCOMES, RAW_COLUMNS
from headway.sources.raw import CLUSTER, PARTITION

ACCEPTED, REJECTED = "accepted", "rejected"
KEYS = ["outcome", PARTITION]
#: At most so many rows in one file of a compacted day.
FILE_ROWS = 10_000_000

LEDGER = "stream string, batch long, run string, inserted long, rejected long, last_day date"
MANIFEST = (
    "version long, inserted long, rejected long, folded map<string, long>,"
    " days array<struct<outcome: string, day: string, version: long>>"
)
DATA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in OUTCOMES if f.name != PARTITION)
STORED = f"{DATA}, stream string, batch long, version long, outcome string, {PARTITION} date"
#: The folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def batch_folder(path: str, stream: str, batch: int) -> str:
    return f"{path}/batches/stream={stream}/batch={batch}"


def _rows(spark: SparkSession, schema: str, path: str) -> list:
    """All rows of a folder of small JSON files, none if there is no such folder."""
    try:
        return spark.read.schema(schema).json(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def ledger(spark: SparkSession, path: str) -> list:
    """The entries of all batches that count, in order."""
    return sorted(_rows(spark, LEDGER, f"{path}/ledger"), key=lambda row: (row.stream, row.batch))


def _folded(manifest, entry) -> bool:
    return manifest is not None and entry.batch <= manifest.folded.get(entry.stream, -1)


def newest_manifest(spark: SparkSession, path: str):
    """The newest one, or None before the first compaction."""
    return max(_rows(spark, MANIFEST, f"{path}/manifest"), key=lambda row: row.version, default=None)


def is_batch_table(spark: SparkSession, path: str) -> bool:
    """Whether the folder was written by ``start_outcomes``."""
    return bool(_rows(spark, LEDGER, f"{path}/ledger"))


def is_committed(spark: SparkSession, path: str, stream: str, batch: int) -> bool:
    return bool(_rows(spark, LEDGER, f"{path}/ledger/stream={stream}/batch={batch}"))


def write_clustered(rows: DataFrame, folder: str, file_rows: int = FILE_ROWS) -> None:
    """Write rows with an ``outcome`` so that a day is in few files, sorted by line and station.

    Replaces what a failed try left there. The rebalance splits a heavy day over tasks and merges light ones.
    """
    (
        rows.hint("rebalance", *KEYS)
        .sortWithinPartitions(*KEYS, *CLUSTER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", file_rows)
        .partitionBy(*KEYS)
        .parquet(folder)
    )


def _one_row(spark: SparkSession, row: tuple, schema: str, folder: str, mode: str) -> None:
    """A file with one row; it is there as a whole or not at all."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode(mode).json(folder)


def commit_batch(spark: SparkSession, path: str, stream: str, batch: int, run: str, rows: DataFrame) -> None:
    """Write a micro-batch's outcomes, then its entry in the ledger; nothing if the entry is there.

    A crash before the entry leaves files that do not count; the same batch, tried again, replaces them. Counts
    are those of the files that were written, which for parquet are in their footers.
    """
    if is_committed(spark, path, stream, batch):
        return
    folder = batch_folder(path, stream, batch)
    outcome = F.when(F.col("reason").isNull(), ACCEPTED).otherwise(REJECTED)
    write_clustered(rows.withColumn("outcome", outcome), folder)
    written = spark.read.schema(STORED).parquet(folder)
    inserted, rejected, last_day = written.agg(
        F.count_if(F.col("outcome") == ACCEPTED), F.count_if(F.col("outcome") == REJECTED), F.max(PARTITION)
    ).first()
    entry = (run, inserted, rejected, last_day)
    target = f"{path}/ledger/stream={stream}/batch={batch}"
    _one_row(spark, entry, "run string, inserted long, rejected long, last_day date", target, "overwrite")


def _read(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    rows = spark.read.schema(STORED).option("basePath", base).parquet(*paths) if paths else spark.createDataFrame([], STORED)
    return rows.select("outcome", *OUTCOMES.fieldNames())


def _read_days(spark: SparkSession, path: str, days) -> DataFrame:
    paths = [f"{path}/days/version={d.version}/outcome={d.outcome}/{PARTITION}={d.day}" for d in days]
    return _read(spark, f"{path}/days", paths)


def _read_batches(spark: SparkSession, path: str, entries, outcome: str | None = None) -> DataFrame:
    counts = {ACCEPTED: "inserted", REJECTED: "rejected"}
    paths = [
        f"{batch_folder(path, e.stream, e.batch)}/outcome={o}"
        for e in entries
        for o, count in counts.items()
        if e[count] and outcome in (None, o)
    ]
    return _read(spark, f"{path}/batches", paths)


def read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """The rows of one outcome: compacted days, and batches since then."""
    manifest = newest_manifest(spark, path)
    days = [d for d in manifest.days if d.outcome == outcome] if manifest else []
    entries = [e for e in ledger(spark, path) if not _folded(manifest, e)]
    return _read_days(spark, path, days).unionAll(_read_batches(spark, path, entries, outcome)).drop("outcome")


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """The raw arrivals; a filter on the day reads only the folders of that day."""
    return read_outcome(spark, path, ACCEPTED).select(*RAW_COLUMNS)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The documents and directions that were rejected, and why."""
    return as_rejects(read_outcome(spark, path, REJECTED))


def totals(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows inserted and rejected by all runs, from the ledger alone."""
    entries = ledger(spark, path)
    return {"inserted": sum(e.inserted for e in entries), "rejected": sum(e.rejected for e in entries)}


def compact(
    spark: SparkSession, path: str, before: dt.date | None = None, file_rows: int = FILE_ROWS
) -> dict[str, int]:
    """Fold batches into clustered days and swap the manifest; what was done.

    ``before`` folds, of every stream, the batches up to the first that holds a row of that day or a later one;
    without it all. A day that gets rows is written anew as a whole, with those it had; other days stay where
    they are. Readers see the old state until the new manifest is there. A crash leaves the old one, and files
    of a version that does not count, which the next try replaces; of two compactions at a time one fails.
    Replaced files stay for readers that still use them, and may go by any rule on age.
    """
    manifest = newest_manifest(spark, path)
    folded = dict(manifest.folded) if manifest else {}
    entries, stopped = [], set()
    for e in ledger(spark, path):
        if not _folded(manifest, e):
            if before is not None and e.last_day is not None and e.last_day >= before:
                stopped.add(e.stream)
            if e.stream not in stopped:
                entries.append(e)
    version = manifest.version if manifest else 0
    if not entries:
        return {"version": version, "batches": 0, "days": 0, "rows": 0}
    version += 1
    fresh = _read_batches(spark, path, entries)
    day = F.coalesce(F.col(PARTITION).cast("string"), F.lit(NO_DAY))
    touched = {tuple(r) for r in fresh.select("outcome", day).distinct().collect()}
    had = [] if manifest is None else [d for d in manifest.days if (d.outcome, d.day) in touched]
    old = _read_days(spark, path, had)
    due = old.count() + sum(e.inserted + e.rejected for e in entries)
    folder = f"{path}/days/version={version}"
    write_clustered(old.unionAll(fresh), folder, file_rows)
    found = spark.read.schema(STORED).parquet(folder).count()
    if found != due:
        raise RuntimeError(f"compaction wrote {found} rows of {due}; the manifest is unchanged")
    kept = [] if manifest is None else [tuple(d) for d in manifest.days if (d.outcome, d.day) not in touched]
    folded.update({e.stream: e.batch for e in entries})
    sums = [sum(e[c] for e in entries) + (manifest[c] if manifest else 0) for c in ("inserted", "rejected")]
    row = (*sums, folded, sorted(kept + [(o, d, version) for o, d in touched]))
    _one_row(spark, row, MANIFEST.removeprefix("version long, "), f"{path}/manifest/version={version}", "error")
    return {"version": version, "batches": len(entries), "days": len(touched), "rows": found}
