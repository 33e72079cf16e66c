"""Stream and batch give the same rows; a restart adds none."""

import datetime as dt
import json

import pytest

from headway.operators.ingest import arrivals_from_schedules, rejected_documents
from headway.schemas import ENVELOPE, EXTENDED_RAW, RAW
from headway.sources.raw import append_raw, append_with_summary, read_raw
from headway.sources.schedules import read_schedule_batch, read_schedule_stream
from headway.streaming.ingest import follow_ingest, ingest_summary, start_ingest, start_rejects, trigger_options

TRAIN = {"seq": "1", "ttnt": "4", "time": "2024-03-01 08:00:00", "dest": "TUC", "plat": "1"}


def land(folder, name, stations, day=1):
    folder.mkdir(exist_ok=True)
    lines = []
    for i, (line, stop) in enumerate(stations):
        payload = {"data": {f"{line}-{stop}": {"UP": [TRAIN], "DOWN": [{**TRAIN, "ttnt": "x" if i % 3 == 0 else "1"}]}}}
        lines.append(
            json.dumps(
                {
                    "line_code": line,
                    "station_code": stop,
                    "fetched_at": f"2024-03-{day:02d}T08:00:0{i}.000Z",
                    "payload": json.dumps(payload),
                }
            )
        )
    (folder / name).write_text("\n".join(lines))


# One pair is unknown, and DOWN of the first is bad: seven rows per file.
PAIRS = [("TCL", "HOK"), ("TCL", "KOW"), ("ISL", "CEN"), ("XXX", "CEN"), ("DRL", "SUN")]


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def places(tmp_path):
    return tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "offsets")


def run(spark, landing, raw, offsets, **how):
    arrivals = arrivals_from_schedules(read_schedule_stream(spark, str(landing), **how))
    query = start_ingest(arrivals, raw, offsets, "once")
    query.awaitTermination()
    return ingest_summary(query)


def test_stream_equals_batch_and_restart_adds_nothing(spark, places):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    land(landing, "b.json", PAIRS, 2)
    assert run(spark, landing, raw, offsets, max_files_per_trigger=1) == {"status": "success", "inserted": 14}
    expected = rows(arrivals_from_schedules(read_schedule_batch(spark, str(landing))))
    assert rows(read_raw(spark, raw)) == expected
    assert run(spark, landing, raw, offsets)["inserted"] == 0
    assert rows(read_raw(spark, raw)) == expected
    land(landing, "c.json", PAIRS[:1], 3)
    assert run(spark, landing, raw, offsets)["inserted"] == 1
    assert read_raw(spark, raw).count() == len(expected) + 1


def test_batch_append(spark, places):
    landing, raw, _ = places
    land(landing, "a.json", PAIRS, 1)
    arrivals = arrivals_from_schedules(read_schedule_batch(spark, str(landing)))
    assert append_with_summary(arrivals, raw) == {"status": "success", "inserted": 7}
    append_raw(arrivals, raw)
    stored = read_raw(spark, raw)
    assert stored.columns == RAW.fieldNames()
    assert stored.count() == 14
    assert {r.ingestion_date for r in stored.collect()} == {dt.date(2024, 3, 1)}


def test_one_day_is_one_partition_filter(spark, places):
    landing, raw, _ = places
    land(landing, "a.json", PAIRS, 1)
    land(landing, "b.json", PAIRS, 2)
    append_raw(arrivals_from_schedules(read_schedule_batch(spark, str(landing))), raw)
    plan = read_raw(spark, raw).filter("ingestion_date = '2024-03-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_extended_raw_is_readable(spark, tmp_path):
    path = str(tmp_path / "ext")
    append_raw(spark.createDataFrame([], EXTENDED_RAW), path)
    spark.createDataFrame(
        [("a", "TCL", "n", "HOK", "d", "1", 1, None, 60, "UP", dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), "s", True, 400)],
        EXTENDED_RAW,
    ).write.mode("append").partitionBy("ingestion_date").parquet(path)
    assert read_raw(spark, path, schema=EXTENDED_RAW).first().delay_seconds == 400


def test_several_raw_tables(spark, places):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    run(spark, landing, raw, offsets)
    other = raw + "-backfill"
    append_raw(arrivals_from_schedules(read_schedule_batch(spark, str(landing))), other)
    assert read_raw(spark, raw, other).count() == 14


def test_triggers():
    assert trigger_options("once") == {"availableNow": True}
    assert trigger_options("30 seconds") == {"processingTime": "30 seconds"}


def test_continuous_trigger(spark, places):
    landing, raw, offsets = places
    land(landing, "a.json", PAIRS, 1)
    query = start_ingest(
        arrivals_from_schedules(read_schedule_stream(spark, str(landing))), raw, offsets, "1 second"
    )
    query.processAllAvailable()
    query.stop()
    assert read_raw(spark, raw).count() == 7


def test_envelope_schema():
    assert ENVELOPE.fieldNames() == ["line_code", "station_code", "fetched_at", "payload"]


def test_rejects_are_stored_once(spark, places, tmp_path):
    landing, _, offsets = places
    land(landing, "a.json", PAIRS, 1)
    (landing / "b.json").write_text('not json\n{"line_code": "TCL", "station_code": "HOK", "payload": "<html>"}\n')
    path = str(tmp_path / "rejects")
    for _ in range(2):
        rejects = rejected_documents(read_schedule_stream(spark, str(landing), 1))
        assert follow_ingest(start_rejects(rejects, path, offsets, "once"))["status"] == "success"
    found = spark.read.parquet(path).select("line_code", "station_code", "direction", "reason")
    # DOWN of the unlisted pair is bad as well, but that document is not parsed.
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [
            ("TCL", "HOK", "DOWN", "bad_wait"),
            ("XXX", "CEN", None, "unlisted_station"),
            ("TCL", "HOK", None, "unparsable_payload"),
            (None, None, None, "unreadable_envelope"),
        ],
        key=str,
    )


def test_rejects_of_chosen_lines(spark, places):
    landing, *_ = places
    land(landing, "a.json", PAIRS)
    found = rejected_documents(read_schedule_batch(spark, str(landing)), lines=["TCL"])
    assert [(r.line_code, r.reason) for r in found.collect()] == [("TCL", "bad_wait")]
