"""Schedule documents to arrival rows, as column expressions: the same plan for batch and stream.

One row comes out per direction, for the first train of that direction. A damaged value costs its
direction only, except a bad sequence number anywhere, or a null or wrongly typed value of a first train,
which cost the whole document. ``rejected`` lists what was lost and why, ``outcomes`` both from one parse.

Values keep their JSON type. An integer is due for the sequence and the wait: a number is cut towards zero, a
boolean counts as 1 or 0, a text must be an integer. A time is a text of which every part but the year may
have one digit; a missing, null, empty, zero or false one means the time of the fetch.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import network
from headway.functions.columns import lookup
from headway.schemas import OUTCOMES, RAW_COLUMNS, REJECT_COLUMNS, SCHEDULE

TIME_FORMAT = "y-M-d H:m:s"  # parts may have one digit
TIME_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"
NO_SEQUENCE = -(2**63)  # marks a sequence number that cannot be read; less than any other


def parse_payload(envelopes: DataFrame) -> DataFrame:
    """Add ``schedule``, the payload as nested columns; ``schedule.data`` is null if it cannot be read."""
    return envelopes.withColumn("schedule", F.from_json("payload", SCHEDULE))


def _value(train: Column, key: str) -> Column:
    """A train's value with its JSON type, null if the key is absent."""
    return F.try_element_at(train, F.lit(key))


def _text_or(train: Column, key: str, default: str) -> Column:
    """A train's value as text; ``default`` if the key is absent, null if it is there and null."""
    text = F.try_variant_get(_value(train, key), "$", "string")
    return F.coalesce(text, F.when(~F.map_contains_key(train, key), F.lit(default)))


def _integer(train: Column, key: str) -> Column:
    """A train's value as an integer: 0 if the key is absent, null if it is none."""
    number = F.try_variant_get(_value(train, key), "$", "bigint")
    return F.coalesce(number, F.when(~F.map_contains_key(train, key), F.lit(0).cast("bigint")))


def _sequence(train: Column) -> Column:
    """Sequence number, 0 if absent, ``NO_SEQUENCE`` if it is not an integer."""
    return F.when(train.isNull(), F.lit(NO_SEQUENCE)).otherwise(F.coalesce(_integer(train, "seq"), F.lit(NO_SEQUENCE)))


def _is_nested(kind: Column) -> Column:
    return kind.startswith("ARRAY") | kind.startswith("OBJECT")


def _wait_fault(train: Column) -> Column:
    """Why a wait costs the whole document, null if it does not."""
    value = _value(train, "ttnt")
    return F.when(F.is_variant_null(value), "null_wait").when(_is_nested(F.schema_of_variant(value)), "wrong_type")


def _clock(train: Column) -> Column:
    """A train's time as text, empty where the time of the fetch is meant, null where it has another type."""
    value = _value(train, "time")
    text, kind = F.try_variant_get(value, "$", "string"), F.schema_of_variant(value)
    unset = value.isNull() | F.is_variant_null(value) | text.isin("", "false", "[]", "{}")
    zero = F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False))
    # A text that says "false" or "[]" is a text, and no time.
    said = (kind == "STRING") & (text != "")
    return F.when(F.coalesce(said, F.lit(False)), text).when(unset | zero, "")


def _of(direction: str, step: str) -> Column:
    return F.col(f"{direction}_{step}")


def _both(df: DataFrame, step: str, expression) -> DataFrame:
    """Add ``<direction>_<step>`` for both directions."""
    return df.withColumns({f"{d}_{step}": expression(d) for d in network.DIRECTIONS})


def _in_either(step: str, test=lambda column: column) -> Column:
    found = [F.coalesce(test(_of(d, step)), F.lit(False)) for d in network.DIRECTIONS]
    return reduce(lambda a, b: a | b, found)


def _first_trains(envelopes: DataFrame) -> DataFrame:
    """Documents with the first train of each direction and ``fault``, the reason to drop them whole.

    Each step is a projection of its own, so the JSON text and the lists are gone through once. A document
    with a reason in ``barred`` is not parsed.
    """
    key = F.concat_ws("-", "line_code", "station_code")
    stamp = F.col("fetched_at")
    stamp_type = envelopes.schema["fetched_at"].dataType
    barred = F.col("barred") if "barred" in envelopes.columns else F.lit(None).cast("string")
    text = F.when(barred.isNull(), F.col("payload"))
    docs = envelopes.withColumns({"barred": barred, "schedule": F.from_json(text, SCHEDULE)})
    docs = docs.withColumn("board", F.try_element_at("schedule.data", key))
    docs = _both(docs, "trains", lambda d: F.col(f"board.{d}"))
    docs = _both(docs, "order", lambda d: F.transform(_of(d, "trains"), _sequence))
    docs = _both(docs, "least", lambda d: F.array_min(_of(d, "order")))
    # The first position of the least number is the earliest listed train on a tie.
    position = {
        d: F.array_position(_of(d, "order"), _of(d, "least")).cast("int") for d in network.DIRECTIONS
    }
    docs = _both(docs, "train", lambda d: F.try_element_at(_of(d, "trains"), position[d]))
    docs = _both(docs, "wait_fault", lambda d: _wait_fault(_of(d, "train")))
    docs = _both(docs, "wait", lambda d: F.try_multiply(_integer(_of(d, "train"), "ttnt"), F.lit(60).cast("bigint")))
    docs = _both(docs, "clock", lambda d: _clock(_of(d, "train")))
    docs = _both(
        docs,
        "time",
        lambda d: F.when(_of(d, "clock") == "", stamp).otherwise(
            F.try_to_timestamp(
                F.regexp_replace(F.when(_of(d, "clock").rlike(TIME_PATTERN), _of(d, "clock")), r"\s+", " "),
                F.lit(TIME_FORMAT),
            ).cast(stamp_type)
        ),
    )
    unreadable = F.col("schedule.data").isNull() & F.col("schedule._corrupt_record").isNotNull()
    # The time is looked at only after the wait was found good.
    timeless = [(F.size(_of(d, "train")) > 0) & (_of(d, "wait") >= 0) & _of(d, "clock").isNull() for d in network.DIRECTIONS]
    return docs.withColumn(
        "fault",
        F.when(F.col("barred").isNotNull(), F.col("barred"))
        .when(unreadable, "unparsable_payload")
        .when(_in_either("least", lambda least: least == NO_SEQUENCE), "bad_sequence")
        .when(_in_either("wait_fault", lambda fault: fault == "null_wait"), "null_wait")
        .when(_in_either("wait_fault", lambda fault: fault.isNotNull()), "wrong_type")
        .when(reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in timeless]), "wrong_type"),
    )


def _reading(direction: str) -> Column:
    """The values of a direction's first train, null if it has none."""
    train, wait, time = (_of(direction, step) for step in ("train", "wait", "time"))
    reason = (
        F.when(wait.isNull(), "bad_wait").when(wait < 0, "negative_wait").when(time.isNull(), "bad_time")
    )
    values = F.struct(
        F.lit(direction).alias("direction"),
        wait.alias("time_remaining"),
        time.alias("arrival_time"),
        _text_or(train, "dest", "").alias("dest_station"),
        _text_or(train, "plat", "").alias("platform"),
        reason.alias("reason"),
    )
    return F.when(F.size(train) > 0, values)


def _readings(envelopes: DataFrame) -> DataFrame:
    """One row per direction that has a train, ``reason`` set where a value is bad.

    A document dropped whole gives one row without direction. The rows leave through a generator:
    Spark would push a filter on plain columns below all these projections and evaluate them twice.
    """
    stamp_type = envelopes.schema["fetched_at"].dataType
    docs = _first_trains(envelopes)
    blank = {
        "direction": "string",
        "time_remaining": "bigint",
        "arrival_time": stamp_type,
        "dest_station": "string",
        "platform": "string",
    }
    dropped = F.struct(
        *[F.lit(None).cast(kind).alias(name) for name, kind in blank.items()],
        F.col("fault").alias("reason"),
    )
    kept = F.array(*[_reading(d) for d in network.DIRECTIONS])
    readings = F.when(F.col("fault").isNull(), kept).otherwise(F.array(dropped))
    return docs.select("line_code", "station_code", "fetched_at", "payload", F.inline(readings)).filter(
        F.col("direction").isNotNull() | F.col("reason").isNotNull()
    )


def _arrival_id(random_ids: bool) -> Column:
    if random_ids:
        return F.expr("uuid()")
    stamp = F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.sha2(F.concat_ws("|", "line_code", "station_code", "direction", stamp), 256)


def with_line_name(df: DataFrame) -> DataFrame:
    """Add ``line_name``; the name table is fixed and tiny, so it sits in the plan as a literal."""
    return df.withColumn(
        "line_name", lookup(F.col("line_code"), network.LINE_NAMES, network.UNKNOWN_LINE_NAME)
    )


def parse_arrivals(envelopes: DataFrame, random_ids: bool = False) -> DataFrame:
    """Arrival rows in the raw schema.

    ``arrival_id`` is by default a hash of what identifies the row, so a replay gives the same ids;
    ``random_ids`` gives a fresh UUID per row. ``fetched_at`` is the one "now" of a document.
    """
    good = _readings(envelopes).filter(F.col("reason").isNull())
    return with_line_name(
        good.withColumns(
            {
                "arrival_id": _arrival_id(random_ids),
                "sequence": F.lit(1).cast("bigint"),
                "ingestion_timestamp": F.col("fetched_at"),
                "ingestion_date": F.to_date("fetched_at"),
            }
        )
    ).select(*RAW_COLUMNS)


def rejected(envelopes: DataFrame) -> DataFrame:
    """What ``parse_arrivals`` drops because of bad values: the document, the direction, the reason.

    Absent boards and empty directions are not errors and do not appear.
    """
    return (
        _readings(envelopes)
        .filter(F.col("reason").isNotNull())
        .select("line_code", "station_code", "fetched_at", "direction", "reason", "payload")
    )


def outcomes(
    envelopes: DataFrame,
    network_pairs: DataFrame | None = None,
    lines: Iterable[str] | None = None,
    random_ids: bool = False,
) -> DataFrame:
    """All that becomes of the documents, from one parse: the rows of ``arrivals_from_schedules``, without a
    ``reason``, and those of ``rejected_documents``, with one and with the ``payload``.

    Rejects have the time of the fetch as their ingestion time, and no arrival id.
    """
    if lines is not None:
        envelopes = envelopes.filter(F.col("line_code").isin(list(lines)) | F.col("line_code").isNull())
    keys = ["line_code", "station_code"]
    if network_pairs is None:
        pairs = F.broadcast(network.station_reference(envelopes.sparkSession).select(*keys, F.lit(True).alias("listed")))
    else:
        pairs = network_pairs.select(*keys).distinct().withColumn("listed", F.lit(True))
    blank = F.coalesce("line_code", "station_code", "payload").isNull()
    barred = F.when(blank, "unreadable_envelope").when(F.col("listed").isNull(), "unlisted_station")
    marked = envelopes.join(pairs, keys, "left").withColumn("barred", barred).drop("listed")
    good = F.col("reason").isNull()
    rows = _readings(marked).withColumns(
        {
            "arrival_id": F.when(good, _arrival_id(random_ids)),
            "sequence": F.when(good, F.lit(1).cast("bigint")),
            "ingestion_timestamp": F.col("fetched_at"),
            "ingestion_date": F.to_date("fetched_at"),
            "payload": F.when(~good, F.col("payload")),
        }
    )
    return with_line_name(rows).select(*OUTCOMES.fieldNames())


def as_rejects(rows: DataFrame) -> DataFrame:
    """Rows of ``outcomes`` that have a reason, with the columns of ``rejected_documents``."""
    return rows.withColumnRenamed("ingestion_timestamp", "fetched_at").select(*REJECT_COLUMNS)


def rejected_documents(
    envelopes: DataFrame, network_pairs: DataFrame | None = None, lines: Iterable[str] | None = None
) -> DataFrame:
    """All that ``arrivals_from_schedules`` drops: as ``rejected``, and documents that are never parsed.

    Those are envelopes that could not be read (``unreadable_envelope``: no line, station or payload) and
    documents of pairs that are not listed (``unlisted_station``). Documents of lines other than the chosen
    ``lines`` are no rejects.
    """
    if lines is not None:
        envelopes = envelopes.filter(F.col("line_code").isin(list(lines)) | F.col("line_code").isNull())
    if network_pairs is None:
        network_pairs = F.broadcast(network.station_reference(envelopes.sparkSession))
    keys = ["line_code", "station_code"]
    blank = F.coalesce("line_code", "station_code", "payload").isNull()
    unlisted = envelopes.join(network_pairs, keys, "left_anti").select(
        *keys,
        "fetched_at",
        F.lit(None).cast("string").alias("direction"),
        F.when(blank, F.lit("unreadable_envelope")).otherwise(F.lit("unlisted_station")).alias("reason"),
        "payload",
    )
    return rejected(envelopes.join(network_pairs, keys, "left_semi")).unionByName(unlisted)


def restrict_to_network(
    envelopes: DataFrame, network_pairs: DataFrame | None = None, lines: Iterable[str] | None = None
) -> DataFrame:
    """Keep documents of known (line, station) pairs, and of ``lines`` if given.

    The built-in reference has 105 rows and is broadcast; a relation of the caller's own is joined
    without a hint, since its size is unknown here.
    """
    if lines is not None:
        envelopes = envelopes.filter(F.col("line_code").isin(list(lines)))
    if network_pairs is None:
        network_pairs = F.broadcast(network.station_reference(envelopes.sparkSession))
    return envelopes.join(network_pairs, ["line_code", "station_code"], "left_semi")


def arrivals_from_schedules(
    envelopes: DataFrame,
    network_pairs: DataFrame | None = None,
    lines: Iterable[str] | None = None,
    random_ids: bool = False,
) -> DataFrame:
    """Landed documents to raw rows, known network only; works on batch and streaming frames."""
    return parse_arrivals(restrict_to_network(envelopes, network_pairs, lines), random_ids)
