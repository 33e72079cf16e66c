"""Statistics over the filtered analysis frame.

Group keys that are null are left out, as in the frame library the reports were first drawn with; the
SQL models keep them. Callers that want several of these from one frame should persist it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from headway.functions.columns import (
    all_present,
    one_decimal_text,
    outside_band,
    round_half_even,
    thousands_text,
)
from headway.operators.distribution import WAIT, value_counts
from headway.operators.frames import station_frame
from headway.operators.waits import SIGMAS
from headway.session import durable

# ---- fixed values -------------------------------------------------------------------------------
TOP_STATIONS = 10
SUMMARY_HEADINGS = {
    "avg_wait": "Avg Wait (min)",
    "std_wait": "Std Dev",
    "var_wait": "Variance",
    "min_wait": "Min (min)",
    "max_wait": "Max (min)",
    "wait_count": "Count",
    "outliers": "Outliers (±2 SD)",
}
# ---- end of fixed values ------------------------------------------------------------------------
BROADCAST_BYTES = 8 << 20
ROW_BYTES = 64


def overview(df: DataFrame, value: str = WAIT, line: str = "line_name") -> DataFrame:
    """One row: rows, mean, sample deviation and variance, and the number of lines seen."""
    v = F.col(value)
    return df.agg(
        F.count(F.lit(1)).alias("total_arrivals"),
        F.avg(v).alias("avg_wait"),
        F.stddev_samp(v).alias("std_wait"),
        F.var_samp(v).alias("var_wait"),
        F.count_distinct(F.col(line)).alias("active_lines"),
    )


def overview_text(overview_row: DataFrame) -> DataFrame:
    """The overview as it is shown: thousands separators, one decimal, ``N/A`` for null."""
    return overview_row.select(
        thousands_text(F.col("total_arrivals")).alias("total_arrivals"),
        one_decimal_text(F.col("avg_wait"), " min").alias("avg_wait"),
        one_decimal_text(F.col("std_wait"), " min").alias("std_wait"),
        F.col("active_lines"),
    )


def outlier_count(df: DataFrame, value: str = WAIT, k: float = SIGMAS) -> DataFrame:
    """Rows strictly outside mean ± k·deviation of the whole frame; 0 if that is undefined.

    The two moments come as one scalar subquery, so the second pass is a plain filtered count.
    """
    v = F.col(value)
    moments = df.agg(F.struct(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))).scalar()
    outside = outside_band(v, moments.getField("mean"), moments.getField("std"), k)
    return df.agg(F.count_if(outside).alias("outlier_count"))


def _mean_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.filter(all_present(keys)).groupBy(*keys).agg(F.avg(value).alias("avg_wait"))


def hourly_line_avg(df: DataFrame, value: str = WAIT) -> DataFrame:
    return _mean_by(df, ["hour", "line_name"], value)


def wait_heatmap(df: DataFrame, value: str = WAIT) -> DataFrame:
    """Mean wait, a row per line and a column per hour 0–23.

    The hours are stated, so no extra job has to look for them; hours without data are null.
    """
    present = df.filter(all_present(["hour", "line_name"]))
    return present.groupBy("line_name").pivot("hour", list(range(24))).agg(F.avg(value))


def line_summary(
    df: DataFrame, value: str = WAIT, line: str = "line_name", k: float = SIGMAS, digits: int = 2
) -> DataFrame:
    """Per line: mean, deviation, variance, ends, count of values, and rows outside mean ± k·deviation.

    The moments are written first, with their size. Up to ``BROADCAST_BYTES`` they are sent to every
    task and a second pass over the rows counts the outliers without a shuffle of rows. Beyond, they
    are joined to the distinct values of each line; adaptive execution splits a line that is heavy.
    """
    v = F.col(value)
    known = df.filter(F.col(line).isNotNull())
    moments = known.groupBy(line).agg(
        F.avg(v).alias("avg_wait"),
        F.stddev_samp(v).alias("std_wait"),
        F.var_samp(v).alias("var_wait"),
        F.min(v).cast("double").alias("min_wait"),
        F.max(v).cast("double").alias("max_wait"),
        F.count(v).alias("wait_count"),
    )
    seen = Observation()
    row_bytes = F.octet_length(F.col(line).cast("string")) + ROW_BYTES
    moments = durable(moments.observe(seen, F.sum(row_bytes).alias("bytes")))
    bands = moments.select(line, "avg_wait", "std_wait")
    outside = outside_band(v, F.col("avg_wait"), F.col("std_wait"), k)
    if (seen.get["bytes"] or 0) <= BROADCAST_BYTES:
        outliers = known.join(F.broadcast(bands), line).groupBy(line).agg(F.count_if(outside).alias("outliers"))
    else:
        counted = F.sum(F.when(outside, F.col("n")).otherwise(0))
        outliers = value_counts(known, value, [line]).join(bands, line).groupBy(line).agg(counted.alias("outliers"))
    rounded = moments.withColumns(
        {
            name: round_half_even(F.col(name), digits)
            for name in ("avg_wait", "std_wait", "var_wait", "min_wait", "max_wait")
        }
    )
    # A line without any value has moments (null) but no distinct values.
    return rounded.join(outliers, line, "left").withColumn(
        "outliers", F.coalesce("outliers", F.lit(0).cast("bigint"))
    )


def line_ranking(df: DataFrame, value: str = WAIT) -> DataFrame:
    """The line summary by ascending mean. ``SUMMARY_HEADINGS`` are its headings as displayed."""
    return line_summary(df, value).orderBy(F.col("avg_wait").asc_nulls_last(), "line_name")


def peak_hours(df: DataFrame, value: str = WAIT) -> DataFrame:
    """Per line the hour with the longest mean wait, the earliest of equals."""
    hourly = hourly_line_avg(df, value)
    rank = F.struct(F.col("avg_wait"), -F.col("hour"))
    return hourly.groupBy("line_name").agg(
        F.max_by("hour", rank).alias("peak_hour"), F.max("avg_wait").alias("peak_wait")
    )


def station_hourly(df: DataFrame, station: str, value: str = WAIT) -> DataFrame:
    return _mean_by(station_frame(df, station), ["hour"], value)


def station_direction(df: DataFrame, station: str, value: str = WAIT) -> DataFrame:
    """Mean per direction and its share of the sum of means; empty unless there are two or more."""
    means = _mean_by(station_frame(df, station), ["direction"], value)
    whole = means.agg(
        F.struct(F.count(F.lit(1)).alias("directions"), F.sum("avg_wait").alias("sum"))
    ).scalar()
    return means.filter(whole.getField("directions") > 1).withColumn(
        "share", F.col("avg_wait") / whole.getField("sum")
    )


def station_line_avg(df: DataFrame, value: str = WAIT) -> DataFrame:
    return _mean_by(df, ["station_code", "line_name"], value)


def top_stations(df: DataFrame, n: int = TOP_STATIONS, value: str = WAIT) -> DataFrame:
    """The ``n`` (station, line) pairs with the longest mean wait; ties in key order."""
    return (
        station_line_avg(df, value)
        .orderBy(F.col("avg_wait").desc_nulls_last(), "station_code", "line_name")
        .limit(n)
    )
