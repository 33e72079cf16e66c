"""The documented report tiles over the hourly fact table and the extended raw table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import clock_hour


def with_delay_flag(df: DataFrame, threshold_seconds: int) -> DataFrame:
    """Set ``is_delayed`` from ``delay_seconds``; the threshold is the caller's, none is defined."""
    return df.withColumn("is_delayed", F.col("delay_seconds") > threshold_seconds)


def tile_wait_by_line(fact: DataFrame) -> DataFrame:
    """Mean wait by line, longest first; hourly means weigh by their sample counts."""
    weight = F.when(F.col("avg_wait_seconds").isNotNull(), F.col("sample_count"))
    return (
        fact.groupBy("line_code")
        .agg((F.sum(F.col("avg_wait_seconds") * weight) / F.sum(weight)).alias("avg_wait_seconds"))
        .orderBy(F.col("avg_wait_seconds").desc_nulls_last(), "line_code")
    )


def tile_delay_trend(arrivals: DataFrame, arrival: str = "arrival_time") -> DataFrame:
    """Delayed arrivals by date, hour and line."""
    return arrivals.groupBy(
        "ingestion_date", clock_hour(F.col(arrival)).alias("hour"), "line_code"
    ).agg(F.count_if("is_delayed").alias("delayed_count"))


def tile_peak_activity(fact: DataFrame) -> DataFrame:
    """Arrivals by hour and station."""
    return fact.groupBy("hour", "station_code").agg(F.sum("sample_count").alias("total_arrivals"))


def tile_delay_share(arrivals: DataFrame) -> DataFrame:
    """Delayed arrivals by line and their share of all delayed arrivals."""
    lines = arrivals.groupBy("line_code").agg(F.count_if("is_delayed").alias("delayed_count"))
    total = lines.agg(F.sum("delayed_count")).scalar()
    return lines.withColumn(
        "share", F.when(total > 0, F.col("delayed_count") / total)
    )


def tile_filter(
    df: DataFrame,
    days: int | None = 7,
    lines: Iterable[str] = (),
    stations: Iterable[str] = (),
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """The filters above the tiles: the last days, some lines, some stations; empty means all."""
    if days is not None:
        today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
        df = df.filter(F.col("ingestion_date") >= F.date_sub(today, days))
    for column, wanted in (("line_code", list(lines)), ("station_code", list(stations))):
        if wanted:
            df = df.filter(F.col(column).isin(wanted))
    return df
