"""Publishing the models: the staging view, and the mart tables."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from headway.plans.models import FACT_COLUMNS, dim_lines, dim_stations, fact_delays, stg_arrivals

MARTS = ("fact_delays", "dim_lines", "dim_stations")


def register_views(
    raw: DataFrame,
    marts: dict[str, DataFrame] | None = None,
    extra: Iterable[str] = (),
    tie_break: Iterable[str] = (),
) -> None:
    """Make ``raw_arrivals`` and ``stg_arrivals`` (and given marts) views for ``spark.sql``."""
    raw.createOrReplaceTempView("raw_arrivals")
    stg_arrivals(raw, extra, tie_break).createOrReplaceTempView("stg_arrivals")
    for name, df in (marts or {}).items():
        df.createOrReplaceTempView(name)


def build_marts(
    spark: SparkSession,
    raw: DataFrame,
    out: str | None = None,
    extra: Iterable[str] = (),
    tie_break: Iterable[str] = (),
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Rebuild the three marts from the raw rows; see ``publish_marts``."""
    return publish_marts(spark, stg_arrivals(raw, extra, tie_break), out, database)


def table_name(name: str, database: str | None = None) -> str:
    return f"{database}.{name}" if database else name


#: The pointer: one small file for each version that was published whole, with the marts' schemas as JSON; the
#: highest counts.
POINTER = "version long, schemas map<string, string>"


def _versions(spark: SparkSession, out: str) -> list:
    """The versions that were published whole, in order; empty for a folder without a pointer."""
    try:
        rows = spark.read.schema(POINTER).json(f"{out}/published").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(rows, key=lambda row: row.version)


def mart_path(out: str, version: int, name: str) -> str:
    return os.path.join(out, f"version={version}", name)


def read_marts(spark: SparkSession, out: str | None = None, database: str | None = None) -> dict[str, DataFrame]:
    """The marts that were published to the folder ``out`` or, without it, to the catalog.

    All three are of one version, the newest when this is called; later ones do not change them.
    """
    if out is None:
        return {name: spark.table(table_name(name, database)) for name in MARTS}
    versions = _versions(spark, out)
    if not versions:
        raise FileNotFoundError(f"no marts were published to {out}")
    version, found = versions[-1].version, {}
    for name, kind in versions[-1].schemas.items():
        schema = T.StructType.fromJson(json.loads(kind))
        found[name] = spark.read.schema(schema).parquet(mart_path(out, version, name)).select(*schema.fieldNames())
    return found


def publish_marts(
    spark: SparkSession, stg: DataFrame, out: str | None = None, database: str | None = None
) -> dict[str, DataFrame]:
    """Write the three marts of ``stg``, as parquet under ``out`` or, without it, as tables of the catalog.

    Under ``out`` they go to a folder of a new version, and a pointer to it is written last: readers get the old
    three until the new three are whole, and a job that dies leaves the old ones; the next replaces what it left.
    Older versions stay for readers that still use them, and may go by any rule on age; of two jobs that publish
    at a time one fails. Tables go to ``database``, or to the current one, and are replaced one after the other.

    Staging is deduplicated once: the fact table has a group for every (line, station) in staging,
    null keys included, so both dimensions are read off the written fact table instead of running the
    dedup again.
    """
    version = 1 + max((row.version for row in _versions(spark, out)), default=0) if out is not None else 0

    def publish(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
        if partition:
            df = df.hint("rebalance", partition)
        # A rebuild replaces the whole mart, also days that are gone from the input.
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition:
            writer = writer.partitionBy(partition)
        if out is None:
            writer.format("parquet").saveAsTable(table_name(name, database))
            return spark.table(table_name(name, database))
        path = mart_path(out, version, name)
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path)  # an empty mart has no files to ask

    fact = publish(fact_delays(stg), "fact_delays", "ingestion_date").select(*FACT_COLUMNS)
    built = {
        "fact_delays": fact,
        "dim_lines": publish(dim_lines(fact), "dim_lines"),
        "dim_stations": publish(dim_stations(fact), "dim_stations"),
    }
    if out is not None:
        schemas = {name: df.schema.json() for name, df in built.items()}
        pointer = spark.createDataFrame([(schemas,)], "schemas map<string, string>").coalesce(1)
        pointer.write.mode("error").json(f"{out}/published/version={version}")
    return built
