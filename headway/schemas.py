"""Schemas of the stored tables and of the incoming messages."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("arrival_id", T.StringType()),
        T.StructField("line_code", T.StringType()),
        T.StructField("line_name", T.StringType()),
        T.StructField("station_code", T.StringType()),
        T.StructField("dest_station", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("arrival_time", T.TimestampType()),
        T.StructField("time_remaining", T.LongType()),  # seconds
        T.StructField("direction", T.StringType()),  # UP | DOWN
        T.StructField("ingestion_timestamp", T.TimestampType(), False),
        T.StructField("ingestion_date", T.DateType(), False),
    ]
)

# Raw rows that also carry delay information, for the delay tiles.
EXTENDED_RAW = T.StructType(
    RAW.fields
    + [
        T.StructField("station_name", T.StringType()),
        T.StructField("is_delayed", T.BooleanType()),
        T.StructField("delay_seconds", T.LongType()),
    ]
)

# One landed document per (line, station) fetch.
ENVELOPE = T.StructType(
    [
        T.StructField("line_code", T.StringType()),
        T.StructField("station_code", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("payload", T.StringType()),
    ]
)

# A train is a map, so that a missing key and an explicit null stay different, of values with their JSON type.
_TRAINS = T.ArrayType(T.MapType(T.StringType(), T.VariantType()))
SCHEDULE = T.StructType(
    [
        T.StructField(
            "data",
            T.MapType(
                T.StringType(),
                T.StructType([T.StructField("UP", _TRAINS), T.StructField("DOWN", _TRAINS)]),
            ),
        ),
        T.StructField("_corrupt_record", T.StringType()),  # filled where the text is not JSON
    ]
)

RAW_COLUMNS = RAW.fieldNames()

# What becomes of a document: accepted rows have no reason, rejects have one and the document's text.
OUTCOMES = T.StructType(
    [T.StructField(f.name, f.dataType) for f in RAW.fields]
    + [T.StructField("reason", T.StringType()), T.StructField("payload", T.StringType())]
)
REJECT_COLUMNS = ["line_code", "station_code", "fetched_at", "direction", "reason", "payload"]
