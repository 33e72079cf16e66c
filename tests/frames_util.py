"""Small analysis frames."""

import datetime as dt

FRAME = (
    "line_name string, station_code string, direction string, hour bigint, date date, "
    "time_remaining_minutes double"
)
DAY = dt.date(2024, 1, 1)


def frame(spark, rows):
    """Rows of (line, station, direction, hour, minutes); the day is fixed."""
    return spark.createDataFrame([(*r[:4], DAY, r[4]) for r in rows], FRAME)


def waits(spark, values, line="A"):
    return frame(spark, [(line, "S1", "UP", 8, v) for v in values])
