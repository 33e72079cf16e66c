"""Projections of the ``events`` sample table into this package's inputs.

``events(event_id, ts, user_id, event_type, value, props)`` has no transit columns; these fixed
projections give every operator realistic input of any size: duplicate ids, an unknown line,
stations on two lines, many tied waits, arrivals past midnight, and damaged messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import network
from headway.functions.columns import lookup, text_array

LINE_CODES = list(network.LINE_NAMES)
UNKNOWN_CODE = "XXX"
DELAY_THRESHOLD_SECONDS = 300  # our assumption: no rule for lateness is given anywhere


def _line_code() -> Column:
    return F.element_at(text_array(LINE_CODES + [UNKNOWN_CODE]), (F.col("user_id") % 11 + 1).cast("int"))


def _station(number: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad((number % 100).cast("string"), 3, "0"))


def raw_from_events(
    events: DataFrame, signed: bool = False, extended: bool = False, gaps: bool = False
) -> DataFrame:
    """Raw arrivals, plus ``event_id`` as a tie-break.

    ``signed`` shifts waits so that some are negative; ``extended`` adds the delay columns; ``gaps``
    leaves out ids, waits, lines, stations and times of some events.
    """
    steps = F.floor(F.col("value") / 10).cast("bigint")
    wait = (steps - 5 if signed else steps) * F.lit(60).cast("bigint")
    line = _line_code()
    raw = events.select(
        F.expr("event_id * 9 div 10").cast("string").alias("arrival_id"),
        line.alias("line_code"),
        lookup(line, network.LINE_NAMES, network.UNKNOWN_LINE_NAME).alias("line_name"),
        _station(F.col("user_id")).alias("station_code"),
        _station(F.col("user_id") + 37).alias("dest_station"),
        (F.col("event_id") % 4 + 1).cast("string").alias("platform"),
        F.lit(1).cast("bigint").alias("sequence"),
        F.timestamp_add("SECOND", wait, F.col("ts")).alias("arrival_time"),
        wait.alias("time_remaining"),
        F.when(F.col("event_id") % 2 == 0, "UP").otherwise("DOWN").alias("direction"),
        F.col("ts").alias("ingestion_timestamp"),
        F.to_date("ts").alias("ingestion_date"),
        F.col("event_id"),
    )
    if gaps:
        every = {
            "arrival_id": 13, "time_remaining": 7, "line_code": 19, "line_name": 19, "station_code": 23, "arrival_time": 17
        }
        raw = raw.withColumns({c: F.when(F.col("event_id") % n != 0, F.col(c)) for c, n in every.items()})
    if extended:
        raw = raw.withColumns(
            {
                "station_name": F.concat(F.lit("Station "), F.col("station_code")),
                "delay_seconds": F.col("time_remaining"),
                "is_delayed": F.col("time_remaining") > DELAY_THRESHOLD_SECONDS,
            }
        )
    return raw


def envelopes_from_events(events: DataFrame) -> DataFrame:
    """Schedule documents, one per event, some of them damaged in a way set by ``event_id``.

    UP lists the later train first, DOWN is absent for every third event. Damage, first match wins:
    multiples of 41 garbage text, 37 no ``data``, 31 a null ``seq``, 29 a null wait, 23 a wait that
    is not a number, 19 a malformed time, 17 a negative wait, 13 an empty time, 11 no destination.
    """
    eid = F.col("event_id")

    def multiple_of(n: int) -> Column:
        return eid % n == 0

    line = _line_code()
    stops = F.create_map(
        *[
            part
            for code in LINE_CODES
            for part in (F.lit(code), text_array(network.LINE_STATIONS[code]))
        ]
    )
    choices = F.coalesce(F.try_element_at(stops, line), text_array(["ZZZ"]))
    station = F.element_at(choices, (F.col("user_id") % F.size(choices) + 1).cast("int"))
    steps = F.floor(F.col("value") / 10).cast("bigint").cast("string")
    clock = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")

    def entry(key: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{key}":'), value)

    def text(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    seq = F.when(multiple_of(31), "null").otherwise('"1"')
    wait = (
        F.when(multiple_of(29), "null")
        .when(multiple_of(23), '"x"')
        .when(multiple_of(17), '"-1"')
        .otherwise(text(steps))
    )
    when = F.when(multiple_of(19), '"not a time"').when(multiple_of(13), '""').otherwise(text(clock))
    dest = F.when(multiple_of(11), "").otherwise(F.concat(entry("dest", text(F.lit("DST"))), F.lit(",")))
    first = F.concat(
        F.lit("{"), entry("seq", seq), F.lit(","), entry("ttnt", wait), F.lit(","),
        entry("time", when), F.lit(","), dest,
        entry("plat", text((eid % 4 + 1).cast("string"))), F.lit("}"),
    )
    later = F.lit('{"seq":"2","ttnt":"99","time":"2030-01-01 00:00:00","dest":"LTR","plat":"9"}')
    plain = F.concat(
        F.lit('{"seq":"1","ttnt":'), text(steps), F.lit(',"time":'), text(clock),
        F.lit(',"dest":"DWN","plat":"2"}'),
    )
    down = F.when(multiple_of(3), "").otherwise(F.concat(F.lit(',"DOWN":['), plain, F.lit("]")))
    body = F.concat(
        F.lit('{"data":{'), text(F.concat_ws("-", line, station)),
        F.lit(':{"UP":['), later, F.lit(","), first, F.lit("]"), down, F.lit("}}}"),
    )
    payload = F.when(multiple_of(41), "<html>").when(multiple_of(37), "{}").otherwise(body)
    return events.select(
        line.alias("line_code"),
        station.alias("station_code"),
        F.col("ts").alias("fetched_at"),
        payload.alias("payload"),
    )


def typed_envelopes_from_events(events: DataFrame) -> DataFrame:
    """Schedule documents, one per event of a known line, whose values have all the types that JSON has.

    The one train's wait goes by ``event_id % 8``, its time by ``event_id % 5``, its sequence by ``event_id % 7``.
    """
    eid = F.col("event_id")
    line = _line_code()
    stops = F.create_map(
        *[part for code in LINE_CODES for part in (F.lit(code), F.element_at(text_array(network.LINE_STATIONS[code]), 1))]
    )
    station = F.try_element_at(stops, line)
    steps = F.floor(F.col("value") / 10).cast("bigint").cast("string")

    def of(n: int, *choices: Column | str) -> Column:
        """The choice of this event; texts are JSON as it stands."""
        return F.element_at(F.array(*[F.lit(c) if isinstance(c, str) else c for c in choices]), (eid % n + 1).cast("int"))

    def text(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    wait = of(
        8, text(steps), F.concat(steps, F.lit(".9")), text(F.concat(steps, F.lit(".9"))), "true",
        F.concat(F.lit("-1"), steps), text(F.concat(F.lit(" +"), steps)), "[1]", F.concat(steps, F.lit("e1")),
    )
    clock = of(5, text(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), text(F.date_format("ts", "yyyy-M-d H:m:s")), "0", "17", "null")
    seq = of(7, "1.5", '"1"', "true", '"1.5"', "-3", '" 2 "', "0")
    train = F.concat(
        F.lit('{"seq":'), seq, F.lit(',"ttnt":'), wait, F.lit(',"time":'), clock,
        F.lit(',"dest":null,"plat":'), (eid % 4).cast("string"), F.lit("}"),
    )
    payload = F.concat(
        F.lit('{"data":{'), text(F.concat_ws("-", line, station)), F.lit(':{"UP":['), train, F.lit("]}}}")
    )
    return events.select(
        line.alias("line_code"), station.alias("station_code"), F.col("ts").alias("fetched_at"), payload.alias("payload")
    ).filter(F.col("station_code").isNotNull())
