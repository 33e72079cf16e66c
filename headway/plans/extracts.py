"""The two parameterised extracts behind the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import clock_hour, with_minutes
from headway.operators.frames import newest
from headway.operators.waits import wait_metrics, with_bands

ALL_DAYS = 9999  # fixed value


def _within_hours(raw: DataFrame, hours_back: int, as_of: dt.datetime | str | None) -> DataFrame:
    """Rows of the trailing hours; the implied bound on the day lets Spark skip whole partitions."""
    stamp_type = raw.schema["ingestion_timestamp"].dataType
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of))
    cutoff = now.cast(stamp_type) - F.make_dt_interval(hours=F.lit(hours_back))
    return raw.filter(
        (F.col("ingestion_timestamp") >= cutoff) & (F.col("ingestion_date") >= F.to_date(cutoff))
    )


def recent_arrivals(
    raw: DataFrame,
    hours_back: int | None = 24,
    as_of: dt.datetime | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The analysis frame: rows of the last ``hours_back`` hours (None, or 0 and less: all).

    ``as_of`` is in UTC, as are the stored times. All rows come, unsorted, since nothing downstream
    depends on their order; a caller's ``limit`` keeps the newest only, newest first.
    """
    rows = _within_hours(raw, hours_back, as_of) if hours_back and hours_back > 0 else raw
    if limit is not None:
        rows = newest(rows, limit, "ingestion_timestamp", "ingestion_date")
    frame = rows.select(
        "arrival_id",
        "line_code",
        "line_name",
        "station_code",
        F.col("time_remaining").alias("time_remaining_seconds"),
        "direction",
        "ingestion_timestamp",
        "ingestion_date",
        clock_hour(F.col("arrival_time")).alias("hour"),
        F.to_date("ingestion_timestamp").alias("date"),
    )
    return with_minutes(frame, ["time_remaining_seconds"])


def hourly_stats(
    raw: DataFrame, days_back: int | None = 7, as_of: dt.date | str | None = None
) -> DataFrame:
    """Hourly statistics with bands over the raw rows, copies included, in seconds and minutes.

    ``days_back`` of None, or 9999 and more, means all days; the bound is on the partition column.
    """
    if days_back is not None and days_back < ALL_DAYS:
        today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
        raw = raw.filter(F.col("ingestion_date") >= F.date_sub(today, days_back))
    timed = raw.withColumn("hour", clock_hour(F.col("arrival_time")))
    stats = with_bands(wait_metrics(timed, value="time_remaining"))
    return with_minutes(stats).orderBy("ingestion_date", "hour", "line_code")
