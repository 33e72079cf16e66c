"""The warehouse models, as functions from frame to lazy frame."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.columns import clock_hour, is_urban, line_color
from headway.operators.dedupe import dedupe_latest
from headway.operators.waits import HOURLY_KEYS, wait_metrics, with_bands, with_wait_category
from headway.schemas import RAW_COLUMNS

RENAMES = {"arrival_time": "scheduled_arrival_time", "time_remaining": "time_remaining_seconds"}
STAGING_COLUMNS = [RENAMES.get(c, c) for c in RAW_COLUMNS]
FACT_COLUMNS = [
    *HOURLY_KEYS,
    "sample_count",
    "avg_wait_seconds",
    "std_wait_seconds",
    "min_wait_seconds",
    "max_wait_seconds",
    "upper_bound_seconds",
    "lower_bound_seconds",
    "wait_category",
]


def stage_source(raw: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Rows that have an id, under the staging names; ``extra`` columns are carried along."""
    return (
        raw.filter(F.col("arrival_id").isNotNull())
        .select(*RAW_COLUMNS, *extra)
        .withColumnsRenamed(RENAMES)
    )


def stg_arrivals(
    raw: DataFrame, extra: Iterable[str] = (), tie_break: Iterable[str] = ()
) -> DataFrame:
    """Staging: the latest row per arrival id.

    Rows of the same id and timestamp are picked from at will, unless ``tie_break`` names staged or
    ``extra`` columns whose greatest value wins.
    """
    order = [F.col(c).desc() for c in ("ingestion_timestamp", *tie_break)]
    return dedupe_latest(stage_source(raw, extra), ["arrival_id"], order)


def dim_lines(arrivals: DataFrame) -> DataFrame:
    """Lines with colour and kind. Accepts staging, or the fact table, which has the same lines."""
    lines = arrivals.select("line_code", "line_name").distinct()
    code = F.col("line_code")
    return lines.withColumns({"line_color": line_color(code), "is_urban": is_urban(code)})


def lines_per_station(arrivals: DataFrame) -> DataFrame:
    """Distinct (station, line) pairs with the number of lines at the station.

    The pairs are distinct before the window, so a plain count counts distinct lines, and the window
    holds a station's lines rather than its arrivals.
    """
    pairs = arrivals.select("station_code", "line_code").distinct()
    return pairs.withColumn(
        "line_count", F.count("line_code").over(Window.partitionBy("station_code"))
    )


def dim_stations(arrivals: DataFrame) -> DataFrame:
    """Stations per line, and whether they are on several. Accepts staging or the fact table."""
    return lines_per_station(arrivals).select(
        "station_code", "line_code", (F.col("line_count") > 1).alias("is_interchange")
    )


def fact_delays(stg: DataFrame) -> DataFrame:
    """Hourly wait statistics by date, hour of arrival, line and station."""
    arrivals = stg.withColumn("hour", clock_hour(F.col("scheduled_arrival_time")))
    metrics = wait_metrics(arrivals)
    return with_wait_category(with_bands(metrics)).filter(F.col("sample_count") > 0).select(*FACT_COLUMNS)
