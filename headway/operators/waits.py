"""Wait statistics per group, their two-sigma band, and the wait category."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOURLY_KEYS = ("ingestion_date", "hour", "line_code", "line_name", "station_code")
SIGMAS = 2.0  # fixed value


def wait_metrics(
    df: DataFrame,
    keys: Iterable[str] = HOURLY_KEYS,
    value: str = "time_remaining_seconds",
    naming: str = "{}_wait_seconds",
) -> DataFrame:
    """Count, mean, sample deviation, least and greatest of ``value`` per group.

    Null keys form a group, as in SQL. Every aggregate merges from partial results, so a heavy group
    is reduced before the shuffle.
    """
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.avg(v).alias(naming.format("avg")),
        F.stddev_samp(v).alias(naming.format("std")),
        F.min(v).alias(naming.format("min")),
        F.max(v).alias(naming.format("max")),
    )


def with_bands(
    df: DataFrame,
    k: float = SIGMAS,
    floor: float = 0.0,
    mean: str = "avg_wait_seconds",
    std: str = "std_wait_seconds",
    upper: str = "upper_bound_seconds",
    lower: str = "lower_bound_seconds",
) -> DataFrame:
    """Add ``mean ± k·std``, the lower end not below ``floor``; no deviation counts as zero.

    A group without any value keeps null bounds: ``greatest`` alone would skip the null.
    """
    spread = F.lit(k) * F.coalesce(F.col(std), F.lit(0.0))
    return df.withColumns(
        {
            upper: F.col(mean) + spread,
            lower: F.when(
                F.col(mean).isNotNull(), F.greatest(F.col(mean) - spread, F.lit(float(floor)))
            ),
        }
    )


def with_wait_category(df: DataFrame) -> DataFrame:
    """Add ``wait_category``; only groups with a positive deviation can be unusual."""
    mean = F.col("avg_wait_seconds")
    unusual = (
        F.when(mean > F.col("upper_bound_seconds"), "unusually_long")
        .when(mean < F.col("lower_bound_seconds"), "unusually_short")
        .otherwise("normal")
    )
    return df.withColumn(
        "wait_category", F.when(F.col("std_wait_seconds") > 0, unusual).otherwise("normal")
    )
