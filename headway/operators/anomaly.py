"""Anomalies among hourly statistics: a mean outside its own band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG, SHORT, NORMAL = "Unusually Long", "Unusually Short", "Normal"  # fixed values


def flag_anomalies(hourly: DataFrame) -> DataFrame:
    """Add ``is_anomaly`` and ``anomaly_type``; comparisons with null count as false."""
    mean = F.col("avg_wait_seconds")
    too_long = F.coalesce(mean > F.col("upper_bound_seconds"), F.lit(False))
    too_short = F.coalesce(mean < F.col("lower_bound_seconds"), F.lit(False))
    return hourly.withColumns(
        {
            "is_anomaly": too_long | too_short,
            "anomaly_type": F.when(too_long, LONG).when(too_short, SHORT).otherwise(NORMAL),
        }
    )


def anomaly_summary(hourly: DataFrame) -> DataFrame:
    """One row: all, long and short anomalies."""
    flagged = flag_anomalies(hourly)
    return flagged.agg(
        F.count_if("is_anomaly").alias("total_anomalies"),
        F.count_if(F.col("anomaly_type") == LONG).alias("unusually_long"),
        F.count_if(F.col("anomaly_type") == SHORT).alias("unusually_short"),
    )


def anomaly_points(hourly: DataFrame) -> DataFrame:
    """Points of the anomaly chart: mean by hour, one facet per line."""
    return (
        flag_anomalies(hourly)
        .filter("is_anomaly")
        .select("hour", "avg_wait_minutes", "anomaly_type", "line_name")
    )


def anomaly_details(hourly: DataFrame, display_names: bool = True) -> DataFrame:
    """The anomalies, latest date first, with headings as displayed."""
    rows = (
        flag_anomalies(hourly)
        .filter("is_anomaly")
        .select(
            "ingestion_date",
            "hour",
            "line_name",
            "station_code",
            "avg_wait_minutes",
            "upper_bound_minutes",
            "lower_bound_minutes",
            "anomaly_type",
        )
        .orderBy(F.col("ingestion_date").desc())
    )
    if not display_names:
        return rows
    return rows.withColumnsRenamed(
        {
            "avg_wait_minutes": "Avg Wait (min)",
            "upper_bound_minutes": "Upper Bound (min)",
            "lower_bound_minutes": "Lower Bound (min)",
        }
    )
