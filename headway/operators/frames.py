"""Choosing rows of the analysis frame, and what there is to choose from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_HOURS = (0, 23)


def filter_frame(
    df: DataFrame,
    date: dt.date | str | None = None,
    lines: Iterable[str] = (),
    hours: tuple[int, int] = ALL_HOURS,
) -> DataFrame:
    """Rows of one date (None: any), of the named lines (empty: any), within an hour range."""
    lines = list(lines)
    if date is not None:
        df = df.filter(F.col("date") == F.lit(str(date)).cast("date"))
    if lines:
        df = df.filter(F.col("line_name").isin(lines))
    return df.filter(F.col("hour").between(*hours))


def filter_domains(df: DataFrame) -> DataFrame:
    """Every value that can be chosen, as ``(domain, value)`` text, sorted: dates, lines, hours.

    One scan: the distinct combinations are few, and are unfolded after they are made distinct.
    """
    combos = df.select("date", "line_name", "hour").distinct()
    options = F.array(
        F.struct(F.lit("date").alias("domain"), F.col("date").cast("string").alias("value")),
        F.struct(F.lit("line").alias("domain"), F.col("line_name").alias("value")),
        F.struct(F.lit("hour").alias("domain"), F.lpad(F.col("hour").cast("string"), 2, "0").alias("value")),
    )
    return (
        combos.select(F.inline(options))
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("domain", "value")
    )


def filter_defaults(df: DataFrame) -> DataFrame:
    """One row with the default choice: the last date and the hours seen."""
    return df.agg(
        F.max("date").alias("default_date"),
        F.min("hour").alias("min_hour"),
        F.max("hour").alias("max_hour"),
    )


def station_list(df: DataFrame) -> DataFrame:
    return df.select("station_code").filter(F.col("station_code").isNotNull()).distinct().orderBy("station_code")


def station_frame(df: DataFrame, station: str) -> DataFrame:
    return df.filter(F.col("station_code") == station)


def newest(df: DataFrame, n: int, time: str, day: str, tie: str = "arrival_id") -> DataFrame:
    """The ``n`` newest rows by ``time``; ``day`` is the date of ``time``, best a partition column.

    The order is total: rows of one time come by a hash of ``tie``, then by ``tie``.

    A plain sort-and-limit keeps ``n`` rows of every input task and merges them all in one task. So
    first find the time of the ``n``-th newest row, from row counts per day, then per second of the
    days left, then per time within the second. Counting days reads no column data, and the day bound
    prunes partitions at run time. Fewer than ``n`` rows are newer than that time; the rows right at
    it, which may be any number, are cut in the same way by the top bits of the hash, so that a whole
    batch stamped with one time does not meet in one task. ``time`` must not be null.
    """

    def reach(frame: DataFrame, unit: str, rising: bool = False) -> Column:
        counts = frame.groupBy(unit).agg(F.count(F.lit(1)).alias("n"))
        # One row per day, second, microsecond of a second or slot: bounded whatever the volume.
        order = "asc" if rising else "desc"
        counts = counts.selectExpr(unit, f"sum(n) over (order by {unit} {order}) - n as before")
        last = F.max(unit) if rising else F.min(unit)
        return counts.filter(F.col("before") < n).agg(last).scalar()

    recent = df.filter(F.col(day) >= reach(df, day))
    second = F.date_trunc("second", time).cast(df.schema[time].dataType)
    since = reach(recent.select(second.alias("second")), "second")
    cutoff = reach(recent.filter(F.col(time) >= since).select(time), time)
    newer = recent.filter(F.col(time) > cutoff)
    level = recent.filter(F.col(time) == cutoff)
    slot = F.shiftrightunsigned(F.xxhash64(tie), 48)
    level = level.filter(slot <= reach(level.select(slot.alias("slot")), "slot", rising=True))
    return newer.union(level).orderBy(F.col(time).desc(), F.xxhash64(tie), tie).limit(n)
