"""Landed schedule documents: one JSON envelope per (line, station) fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.schemas import ENVELOPE


def read_schedule_batch(spark: SparkSession, path: str) -> DataFrame:
    """All envelopes in a folder, as a one-shot batch."""
    return spark.read.schema(ENVELOPE).json(path)


def read_schedule_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New envelopes as they land. A number of files or of bytes per trigger bounds one micro-batch.

    ``archive``: a folder outside ``path`` to which files go once their micro-batch is done, so that a trigger
    lists only what is new, not all that ever landed. A file there was read; it is never read again. Files of
    the last micro-batch stay until the next one.
    """
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)
