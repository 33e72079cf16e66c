"""The raw arrivals table: parquet, one folder per ingestion day, files ordered by line and station."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas

PARTITION = "ingestion_date"
CLUSTER = ("line_code", "station_code")


def read_raw(spark: SparkSession, *paths: str, schema: T.StructType = schemas.RAW) -> DataFrame:
    """Batch scan of one or more raw tables with a declared schema.

    Each path is read on its own: the folder of a streaming sink is then read through its commit
    log, so files of a failed micro-batch are never seen.
    """
    parts = [spark.read.schema(schema).parquet(path) for path in paths]
    return reduce(DataFrame.unionByName, parts).select(*schema.fieldNames())


def read_raw_table(spark: SparkSession, *names: str, schema: T.StructType = schemas.RAW) -> DataFrame:
    """The same from one or more tables of the catalog, such as ``db.raw_arrivals``; other columns are left out."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return reduce(DataFrame.unionByName, [spark.table(name).select(*columns) for name in names])


def append_raw(df: DataFrame, path: str, observation: Observation | None = None) -> None:
    """Append rows to the day-partitioned table.

    The rebalance hint lets adaptive execution split a heavy day over many tasks and merge light
    days, so a batch neither funnels one day into one task nor writes a file per task and day.
    Write a streaming sink's folder only with its stream: readers of such a folder trust its log.
    """
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("inserted"))
    (
        df.hint("rebalance", PARTITION)
        .sortWithinPartitions(PARTITION, *CLUSTER)
        .write.partitionBy(PARTITION)
        .mode("append")
        .parquet(path)
    )


def append_with_summary(df: DataFrame, path: str) -> dict:
    """Append and report ``{"status", "inserted"}``; the count rides along with the write."""
    observation = Observation("ingest")
    append_raw(df, path, observation)
    return {"status": "success", "inserted": observation.get["inserted"]}
